"""Weighted shares and means with intervals for stratified samples.

Each answer carries a weight and a stratum.  A share is a ratio of two weighted sums; its
variance is that of the linearised residuals ``w * (y - p) / W`` (zero outside the
group), added up over strata, each about its own mean.  All that needs is, per plan row, repeat
value, group, answer and stratum: counts, sums of weights and of squared weights.  So one scan and one
partial aggregate serve every plan row, weighted or not, and the rest is arithmetic on aggregated rows
(numerical plan rows take one scan more, for the constant near their mean).

With weights of 1 and no strata the results are those of :func:`analysis.run_plan`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formsieve.functions.nulls import col
from formsieve.functions.text import to_number
from formsieve.plans.analysis import Z_95, plan_cells, plan_meta, plan_variables
from formsieve.session import materialize

SQUARE = lambda c: c * c


def _interval(numbers: Column, se: Column, share: Column) -> tuple[Column, Column]:
    lo, hi = numbers - F.lit(Z_95) * se, numbers + F.lit(Z_95) * se
    return F.when(share, F.greatest(F.lit(0.0), lo)).otherwise(lo), F.when(share, F.least(F.lit(1.0), hi)).otherwise(hi)


def run_weighted_plan(df: DataFrame, plan, weight: str | None = None, strata: str | None = None, sample_correction: bool = False,
                      report: list | None = None) -> DataFrame:
    """The plan's shares and means, weighted, with standard errors of the stratified design.

    ``weight`` names a column of positive numbers: rows with another or no weight count nowhere.
    ``strata`` names the strata; null is a stratum of its own.  A stratum's squared residuals are divided by its
    number of answers, as unweighted shares always were; with ``sample_correction`` by
    that number less one (a stratum of one answer then adds nothing).  Without it, a mean's variance gets ``n / (n - 1)`` of
    its group, as unweighted means always did.  Columns as in :data:`analysis.RESULT_COLUMNS` + ``is_percent``."""
    cat_rows, num_rows = plan_variables(df, plan, report)
    w = to_number(weight) if weight else F.lit(1.0)
    df = df.filter(w > 0) if weight else df
    # sums of squares are taken about a constant near the mean, so that they don't cancel
    centres = df.agg(*[F.avg(to_number(d)).alias(f"c{i}") for i, (d, *_) in enumerate(num_rows)]).first() if num_rows else ()
    s = col(strata).cast("string") if strata else F.lit(None).cast("string")
    long, specs = plan_cells(df, cat_rows, num_rows, also={"w": w, "s": s})
    sums = [F.count(F.lit(1)).alias("n"), F.sum("w").alias("w1"), F.sum(SQUARE(F.col("w"))).alias("w2")]
    if num_rows:
        centre = F.element_at(F.array(*[F.lit(0.0)] * len(cat_rows), *[F.lit(c if c is not None else 0.0) for c in centres]), F.col("id") + 1)
        long = long.withColumn("x", F.col("x") - centre)
        wx, w2x = F.col("w") * F.col("x"), SQUARE(F.col("w")) * F.col("x")
        sums += [F.sum(wx).alias("wx"), F.sum(w2x).alias("w2x"), F.sum(w2x * F.col("x")).alias("w2xx")]
    # a row per plan row, group, answer and stratum: kept, so that shares, means and totals read the data once
    cells = materialize(long.groupBy("id", "r", "g", "val", "s").agg(*sums))
    # everybody who answered in the stratum, whatever the group: outside the group a residual is zero
    cells = cells.withColumn("n_s", F.sum("n").over(Window.partitionBy("id", "r", "s")))
    one = F.lit(1.0)
    c = F.when(F.col("n_s") > 1, F.col("n_s") / (F.col("n_s") - 1)).otherwise(one) if sample_correction else one
    cells = cells.withColumn("c", c)
    parts = []
    if cat_rows:
        parts.append(_shares(cells.filter(F.col("id") < len(cat_rows))))
    if num_rows:
        parts.append(_means(cells.filter(F.col("id") >= len(cat_rows)), centre, sample_correction))
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    meta = plan_meta(specs)
    se = F.sqrt(F.greatest(F.col("var"), F.lit(0.0)))
    lo, hi = _interval(F.col("numbers"), se, meta["share"])
    return found.select(meta["var"].alias("dependent.var"), F.col("val").alias("dependent.var.value"), meta["gv"].alias("independent.var"),
                        F.col("g").alias("independent.var.value"), "numbers", se.alias("se"), lo.alias("min"), hi.alias("max"),
                        meta["rv"].alias("repeat.var"), F.col("r").alias("repeat.var.value"), meta["share"].alias("is_percent"))


def _shares(cells: DataFrame) -> DataFrame:
    """(id, r, g, val, numbers, var) of categorical rows; ``cells`` per (id, r, g, val, s)."""
    cells = cells.withColumn("g1", F.sum("w1").over(Window.partitionBy("id", "r", "g", "s")))
    share = F.col("c") / F.col("n_s")
    a = cells.groupBy("id", "r", "g", "val").agg(
        F.sum("w1").alias("w1"), F.sum(F.col("c") * F.col("w2")).alias("a"),
        F.sum(share * SQUARE(F.col("w1"))).alias("b1"), F.sum(share * F.col("w1") * F.col("g1")).alias("b2"))
    # the group's own sums over strata are the sums of its answers'
    group = Window.partitionBy("id", "r", "g")
    a = a.select("*", F.sum("w1").over(group).alias("gw"), F.sum("a").over(group).alias("ga"), F.sum("b2").over(group).alias("gb"))
    p = F.col("w1") / F.col("gw")
    squares = (1 - 2 * p) * F.col("a") + p * p * F.col("ga")
    about_means = F.col("b1") - 2 * p * F.col("b2") + p * p * F.col("gb")
    return a.select("id", "r", "g", "val", p.alias("numbers"), ((squares - about_means) / SQUARE(F.col("gw"))).alias("var"))


def _means(cells: DataFrame, centre: Column, sample_correction: bool) -> DataFrame:
    """(id, r, g, val, numbers, var) of numerical rows; ``cells`` per (id, r, g, s), about ``centre``."""
    group = Window.partitionBy("id", "r", "g")
    a = cells.select("*", F.sum("w1").over(group).alias("gw"), F.sum("wx").over(group).alias("gwx"))
    m = F.col("gwx") / F.col("gw")
    squares = F.col("w2xx") - 2 * m * F.col("w2x") + m * m * F.col("w2")
    about_mean = SQUARE(F.col("wx") - m * F.col("w1")) / F.col("n_s")
    out = a.select("*", m.alias("m"), (F.col("c") * (squares - about_mean) / SQUARE(F.col("gw"))).alias("v")) \
        .groupBy("id", "r", "g", "val").agg(F.max("m").alias("m"), F.sum("v").alias("v"), F.sum("n").alias("n"))
    n = F.col("n").cast("double")
    var = F.col("v") if sample_correction else F.when(n > 1, F.col("v") * n / F.when(n > 1, n - 1))
    return out.select("id", "r", "g", "val", (F.col("m") + centre).alias("numbers"), var.alias("var"))
