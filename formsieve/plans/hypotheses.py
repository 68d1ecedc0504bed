"""Hypothesis tests of an analysis plan (J14 with D8 / D9).

Whether groups differ is tested from the counts and moments that the plan's own aggregate
gives: one scan and one partial aggregate for all plan rows, checkpointed as the few rows that it is.

* categorical answers: Pearson's chi-square of answers by groups;
* numbers: Welch's test of equal means with unequal variances (two groups: his t-test, whose
  squared statistic is this F; more groups: his analysis of variance).

A test that is undefined (one group, one answer, a group of a single number or without
variance) has a null statistic and p-value.  P-values are native expressions
(:mod:`formsieve.functions.special`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formsieve.functions.nulls import col
from formsieve.functions.special import chi_square_p, f_p
from formsieve.plans.analysis import plan_cells, plan_meta, plan_variables
from formsieve.session import materialize

# Names of the tests and the columns of their results.
CHI_SQUARE, WELCH = "chi-square", "welch"
TEST_KEYS = ["dependent.var", "independent.var", "repeat.var", "repeat.var.value"]
TEST_COLUMNS = [*TEST_KEYS, "test", "n", "statistic", "df1", "df2", "p.value"]


def _with_totals(cells: DataFrame, totals: DataFrame) -> DataFrame:
    """The totals of a plan row and repeat value beside its cells (a null repeat value is one)."""
    t = totals.withColumnsRenamed({"id": "_id", "r": "_r"})
    return cells.join(t, (cells["id"] == t["_id"]) & cells["r"].eqNullSafe(t["_r"])).drop("_id", "_r")


def _chi_square(cells: DataFrame) -> DataFrame:
    """(id, r, n, statistic, df1) from counts ``_n`` per (id, r, g, val)."""
    cells = cells.select("id", "r", "g", "val", "_n",
                         F.sum("_n").over(Window.partitionBy("id", "r", "g")).alias("_g"),
                         F.sum("_n").over(Window.partitionBy("id", "r", "val")).alias("_v"))
    totals = cells.groupBy("id", "r").agg(F.sum("_n").alias("n"))
    e = F.col("_g") * F.col("_v").cast("double") / F.col("n")
    found = _with_totals(cells, totals).withColumn("_e", e).groupBy("id", "r").agg(
        F.max("n").alias("n"), F.count(F.lit(1)).alias("_cells"), F.count_distinct("g").alias("_gs"), F.count_distinct("val").alias("_vs"),
        F.sum((F.col("_n") - F.col("_e")) * (F.col("_n") - F.col("_e")) / F.col("_e")).alias("_x"), F.sum("_e").alias("_es"))
    # a cell that nobody is in adds its expected count; the sum over such cells is what the others lack
    empty = F.when(F.col("_cells") < F.col("_gs") * F.col("_vs"), F.col("n") - F.col("_es")).otherwise(F.lit(0.0))
    df = ((F.col("_gs") - 1) * (F.col("_vs") - 1)).cast("double")
    fine = df > 0
    x = F.when(fine, F.col("_x") + empty)
    return found.select("id", "r", "n", x.alias("statistic"), F.when(fine, df).alias("df1"), F.lit(None).cast("double").alias("df2"))


def _welch(cells: DataFrame) -> DataFrame:
    """(id, r, n, statistic, df1, df2) from ``_n``, ``_m``, ``_sd`` per (id, r, g)."""
    ok = (F.col("_n") > 1) & (F.col("_sd") > 0)
    # the other branch is never divided by zero
    w = F.when(ok, F.col("_n") / F.when(ok, F.col("_sd") * F.col("_sd")))
    cells = cells.select("id", "r", "_n", "_m", w.alias("_w"))
    totals = cells.groupBy("id", "r").agg(F.sum("_w").alias("_wt"), F.sum(F.col("_w") * F.col("_m")).alias("_wm"), F.count(F.lit(1)).alias("_k"),
                                          F.count("_w").alias("_ok"), F.sum("_n").alias("n"))
    mean = F.try_divide(F.col("_wm"), F.col("_wt"))
    rest = 1 - F.try_divide(F.col("_w"), F.col("_wt"))
    found = _with_totals(cells, totals).groupBy("id", "r").agg(
        F.max("n").alias("n"), F.max("_k").alias("_k"), F.max("_ok").alias("_ok"), F.sum(F.col("_w") * (F.col("_m") - mean) * (F.col("_m") - mean)).alias("_a"),
        F.sum(F.try_divide(rest * rest, F.col("_n") - 1)).alias("_l"))
    k = F.col("_k").cast("double")
    fine = (F.col("_k") > 1) & (F.col("_ok") == F.col("_k"))
    spread = k * k - 1
    between = F.try_divide(F.col("_a"), k - 1)
    statistic = F.try_divide(between, 1 + F.try_divide(2 * (k - 2) * F.col("_l"), spread))
    return found.select("id", "r", "n", F.when(fine, statistic).alias("statistic"), F.when(fine, k - 1).alias("df1"),
                        F.when(fine, F.try_divide(spread, 3 * F.col("_l"))).alias("df2"))


def plan_tests(df: DataFrame, plan, report: list | None = None) -> DataFrame:
    """One test per plan row with a grouping variable and repeat value: :data:`TEST_COLUMNS`."""
    cat_rows, num_rows = (tuple(r for r in rows if r[1]) for rows in plan_variables(df, plan, report))
    if not cat_rows and not num_rows:
        raise ValueError("no plan row has a grouping variable")
    long, specs = plan_cells(df, cat_rows, num_rows)
    aggs = [F.count(F.lit(1)).alias("_n")]
    if num_rows:
        aggs += [F.avg("x").alias("_m"), F.stddev_samp("x").alias("_sd")]
    # a row per plan row, group and answer: kept, so that both kinds of tests and their totals read the data once
    cells = materialize(long.groupBy("id", "r", "g", "val").agg(*aggs))
    parts = []
    if cat_rows:
        parts.append(_chi_square(cells.filter(F.col("id") < len(cat_rows)))
                     .withColumn("p.value", chi_square_p(F.col("statistic"), F.col("df1"))).withColumn("test", F.lit(CHI_SQUARE)))
    if num_rows:
        parts.append(_welch(cells.filter(F.col("id") >= len(cat_rows)))
                     .withColumn("p.value", f_p(F.col("statistic"), F.col("df1"), F.col("df2"))).withColumn("test", F.lit(WELCH)))
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    meta = plan_meta(specs)
    return found.select(meta["var"].alias("dependent.var"), meta["gv"].alias("independent.var"), meta["rv"].alias("repeat.var"),
                        F.col("r").alias("repeat.var.value"), "test", "n", "statistic", "df1", "df2",
                        F.when(F.col("statistic").isNotNull(), col("p.value")).alias("p.value"))


def attach_tests(results: DataFrame, tests: DataFrame) -> DataFrame:
    """Every result row with its test's name and p-value; null where none is defined."""
    t = tests.select(*[col(k).alias(f"_t{i}") for i, k in enumerate(TEST_KEYS)], "test", col("p.value"))
    on = [col(k).eqNullSafe(F.col(f"_t{i}")) for i, k in enumerate(TEST_KEYS)]
    return results.join(t, on, "left").drop(*[f"_t{i}" for i in range(len(TEST_KEYS))])
