"""Plan shapes that matter at scale: no window over a data key (a hot key would land
whole in one task), pushdown and pruning reaching the scan, results right under skew."""

import os

import pytest
from pyspark.sql import functions as F

from formsieve.operators import aggregate as agg
from formsieve.operators import checks
from formsieve.operators.corrections import apply_log
from formsieve.plans import analysis
from formsieve.plans.catalog import QUERIES
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    # one key holds a third of all rows
    n = 3000
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
        .alias("k"),
        (F.col("id") % 5).cast("string").alias("cat"),
        F.col("id").alias("o"),
        (F.col("id") % 7).cast("string").alias("w"))


def windows_only_above_aggregates(plan: str) -> bool:
    """Every Window in the plan has a HashAggregate between it and the data source."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line:
            below = lines[i + 1:]
            src = next((j for j, l in enumerate(below) if "Range (" in l or "Scan" in l), len(below))
            if not any("HashAggregate" in l for l in below[:src]):
                return False
    return True


def test_no_window_over_raw_rows_and_one_scan(spark, skewed):
    for df in [agg.weighted_mode(skewed, "k", "cat", "w", "m"),
               agg.weighted_modes(skewed, "k", [("cat", "w", "m1"), ("o", "w", "m2")]),
               agg.mode_first_seen(skewed, "k", "cat", "o"),
               analysis.categorical_shares(skewed, ["cat"], "k")]:
        plan = physical(df)
        assert windows_only_above_aggregates(plan), plan
        assert plan.count("Range (") == 1, plan
    assert "Window" not in physical(checks.duplicated_rows(skewed, "k"))


def test_results_right_under_skew(spark, skewed):
    d = checks.duplicated_rows(skewed, "k")
    assert d.filter(F.col("k") == "hot").select("freq").distinct().collect()[0][0] == 1000
    shares = analysis.categorical_shares(skewed, ["cat"], "k")
    hot = {r["dependent.var.value"]: r["numbers"] for r in shares.filter(F.col("`independent.var.value`") == "hot").collect()}
    # ids divisible by 3: residues mod 5 are equally frequent
    assert sorted(hot) == ["0", "1", "2", "3", "4"] and abs(sum(hot.values()) - 1) < 1e-12


def test_correction_plan_has_one_join_and_no_window(spark):
    data = spark.createDataFrame([("u1", "a")], "uuid string, name string")
    log = spark.createDataFrame([("u1", "name", "b", "TRUE", 1)],
                                "uuid string, variable string, new_value string, change string, ord long")
    out = apply_log(data, log)
    plan = physical(out)
    assert "Window" not in plan and plan.count("Join") == 1
    assert rows(out) == [("u1", "b")]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_filters_and_columns_reach_the_scan(spark):
    plan = physical(QUERIES["recode_derive"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderpriority), Not(EqualTo(o_orderpriority,5-LOW))]" in plan
    scan = [line for line in physical(QUERIES["dup_keys"](spark, SF)).splitlines() if "FileScan" in line]
    assert scan and all("p_retailprice" not in s and "p_size" not in s for s in scan)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_rule_set_is_one_scan_without_shuffle(spark):
    plan = physical(QUERIES["rule_range"](spark, SF))
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_mixed_plan_is_one_scan_and_one_shuffle(spark, skewed):
    plan = [{"dependent.variable": "cat", "dependent.variable.type": "categorical", "independent.variable": "k"},
            {"dependent.variable": "o", "dependent.variable.type": "numerical", "independent.variable": "k"},
            {"dependent.variable": "o", "dependent.variable.type": "numerical", "independent.variable": "w"},
            {"dependent.variable": "w", "dependent.variable.type": "numerical"}]
    res = analysis.run_plan(skewed, plan)
    p = physical(res)
    assert p.count("Range (") == 1, p
    # one partial aggregate over the raw rows; every exchange carries aggregated rows
    assert p.count("partial_count(1)") == 1, p
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "Exchange " in line:
            below = lines[i + 1:]
            src = next(j for j, l in enumerate(below) if "Range (" in l)
            assert any("HashAggregate" in l for l in below[:src]), p
    assert windows_only_above_aggregates(p), p
    # the numerical rows equal the stand-alone mean operator, the hot group included
    got = {(r[0], r[1]): round(r[2], 9) for r in res.filter(~F.col("is_percent")).filter(F.col("`independent.var`") == "k")
           .select("`dependent.var`", "`independent.var.value`", "numbers").collect()}
    want = {(r[0], r[1]): round(r[2], 9) for r in analysis.numeric_means(skewed, ["o"], "k")
            .select("`dependent.var`", "`independent.var.value`", "numbers").collect()}
    assert got == want and len(got) == 98


def test_row_rule_paths_have_no_lambdas(spark):
    # higher-order functions run outside generated code; the hot row paths avoid them
    for name in ["rule_range", "rule_cross_field", "outliers", "duration_check", "issue_log", "plan_shares",
                 "auto_plan"]:
        plan = physical(QUERIES[name](spark, SF))
        assert "lambdafunction" not in plan.lower(), (name, plan)
