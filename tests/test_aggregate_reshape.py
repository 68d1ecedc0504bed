"""Aggregates, plan runner, reshaping and site codes."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from formsieve.operators import aggregate as agg
from formsieve.operators import reshape
from formsieve.operators.sitecodes import assign_site_codes, global_rank
from formsieve.plans import analysis
from tests.conftest import rows
from tests.fixtures import responses_df


def test_weighted_mode_keeps_ties_and_drops_na_weights(spark):
    df = spark.createDataFrame([("g1", "a", "10"), ("g1", "b", "10"), ("g1", "c", "5"),
                                ("g2", "a", None), ("g2", "b", "1"), ("g3", "a", None)],
                               "g string, cat string, w string")
    out = agg.weighted_mode(df, "g", "cat", "w", "mode")
    assert rows(out) == [("g1", "a"), ("g1", "b"), ("g2", "b")]
    assert rows(agg.weighted_mode(df, "g", "cat", "w", "mode", ties="first")) == [("g1", "a"), ("g2", "b")]


def test_mode_first_seen(spark):
    df = spark.createDataFrame([("u", "x", 3), ("u", "y", 1), ("u", "x", 5), ("u", "y", 2), ("v", None, 1),
                                ("v", None, 2), ("v", "z", 3)], "g string, v string, o int")
    assert rows(agg.mode_first_seen(df, "g", "v", "o")) == [("u", "y"), ("v", None)]


def test_group_count_and_strict_sums_drop_null_groups(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "x"), (None, "5")], "g string, v string")
    assert rows(agg.group_count(df, "g")) == [("a", 2), ("b", 1)]
    assert rows(agg.group_strict_sums(df, "g", {"s": "v"})) == [("a", 3.0), ("b", None)]


def test_multiple_response_with_total(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (0, 0)], "a int, b int")
    out = {r.question: (r.freq, r.percent, r.percentofcases) for r in agg.multiple_response(df, ["a", "b"]).collect()}
    assert out["a"] == (2.0, 2 / 3 * 100, 100.0)
    assert out["Total"] == (3.0, 100.0, 150.0)


def test_plan_shares_sum_to_one(spark):
    df = responses_df(spark, 120)
    plan = [{"dependent.variable": "c1_type_of_site", "dependent.variable.type": "categorical",
             "independent.variable": "a1_governorate_name", "repeat.for.variable": None},
            {"dependent.variable": "C3_TENANCY_AGREEMENT_FOR_AT_LEAST_6_MONTHS",  # case differs: still resolves
             "independent.variable": "a1_governorate_name"},
            {"dependent.variable": "not_a_column", "independent.variable": "a1_governorate_name"}]
    report = []
    res = analysis.run_plan(df, plan, report)
    assert report == [{"dependent.variable": "not_a_column", "reason": "column absent"}]
    sums = res.groupBy("`dependent.var`", "`independent.var.value`").agg(F.sum("numbers").alias("s")).collect()
    assert sums and all(abs(r.s - 1.0) < 1e-12 for r in sums)
    assert res.filter((F.col("min") < 0) | (F.col("max") > 1)).count() == 0


def test_auto_plan_types(spark):
    df = spark.createDataFrame([], "g string, x double, s string, n int")
    plan = analysis.auto_plan(df, independent="g")
    assert [(p.dependent, p.dependent_type) for p in plan] == [("x", "numerical"), ("s", "categorical"),
                                                               ("n", "numerical")]
    q = analysis.auto_plan(df, questions={"g": "select_one g", "x": "integer", "s": "text", "n": "calculate"},
                           independent="g")
    assert [(p.dependent, p.dependent_type) for p in q] == [("x", "numerical"), ("n", "numerical")]


def test_merge_table_and_confints(spark):
    res = spark.createDataFrame([
        ("q", "a", "gov", "G1", 0.25, 0.1, 0.2, 0.3), ("q", "b", "gov", "G1", 0.75, 0.1, 0.6, 0.9),
        ("q", "a", "gov", "G2", 1.0, 0.0, 1.0, 1.0)],
        "`dependent.var` string, `dependent.var.value` string, `independent.var` string, "
        "`independent.var.value` string, numbers double, se double, min double, max double")
    wide = reshape.to_merge_table(res)
    assert rows(wide) == [("G1", 0.25, 0.75), ("G2", 1.0, None)]
    ci = reshape.to_merge_table_confints(res, ["q:::a", "q:::b"], rows=("independent.var", "independent.var.value"))
    assert "q:::a_numbers" in ci.columns and ci.count() == 2


def test_union_onto_template_fixes_order_and_types(spark):
    template = spark.createDataFrame([], "a string, b double, c string")
    part = spark.createDataFrame([(1, "x", "extra")], "b int, a string, d string")
    out = reshape.union_onto_template(template, [part])
    assert out.columns == ["a", "b", "c", "d"] and dict(out.dtypes)["b"] == "double"


def test_global_rank_equals_row_number(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 1000).alias("k"), F.col("id").alias("o"))
    ranked = global_rank(df, ["k", "o"], "rn", num_partitions=7)
    expected = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "o")))
    assert rows(ranked, "o", "rn") == rows(expected, "o", "rn")


def test_site_codes(spark):
    df = spark.createDataFrame([(1, None, "b", "D1"), (2, "K7", "a", "D1"), (3, None, "a", None),
                                (4, None, None, "D2"), (5, None, "a", "D1")],
                               "idx long, code string, name string, district string")
    out = dict(assign_site_codes(df, "code", "name", "district", "idx", first=10, last=11)
               .select("idx", "code").collect())
    # order among missing codes: name nulls first, then original row: 4, 3, 5, 1
    assert out == {2: "K7", 4: "D2_10", 3: "NA_11", 5: "D1_10", 1: "D1_11"}


def test_any_not_null_flags(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", None, None), ("b", 2.0, None)], "g string, lo double, hi double")
    assert rows(agg.any_not_null(df, ["g"], ["lo", "hi"])) == [("a", False, True), ("b", True, False)]


def test_scoped_result_labels(spark):
    from tests.fixtures import dictionary_df
    res = spark.createDataFrame([("org", "mdf"), ("org2", "mdf")], "`dependent.var` string, `dependent.var.value` string")
    lists = spark.createDataFrame([("org", "ngo"), ("org2", "ngo2")], "name string, list_name string")
    out = analysis.label_results(res, dictionary_df(spark), lists)
    assert rows(out) == [("org", "mdf", "MDF first"), ("org2", "mdf", "MDF second")]
    unscoped = analysis.label_results(res, dictionary_df(spark))
    assert {r[2] for r in unscoped.collect()} == {"MDF first"}


def test_merge_table_rejects_duplicate_cells(spark):
    import pytest
    res = spark.createDataFrame([("q", "a", "G1", 0.25), ("q", "a", "G1", 0.5)],
                                "`dependent.var` string, `dependent.var.value` string, `independent.var.value` string, "
                                "numbers double")
    with pytest.raises(ValueError):
        reshape.to_merge_table(res)


def test_strict_union_and_stack(spark):
    import pytest
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    assert rows(reshape.stack([a, b])) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        reshape.union_strict([a, spark.createDataFrame([(1,)], "k int")])


def test_merge_table_keeps_null_and_unseen_answers(spark):
    """Keys come from the results: a null answer is ``NA``, any new answer a column; empty cells are null."""
    cells = [("q1", "yes", "A", 0.25), ("q1", "yes", "B", 0.5), ("q1", None, "A", 0.75), ("q1", "never seen", "B", 0.5), ("q2", "x.y", None, 1.0), ("n", None, "B", 7.5)]
    res = spark.createDataFrame(cells, "`dependent.var` string, `dependent.var.value` string, `independent.var.value` string, numbers double")
    wide = reshape.to_merge_table(res)
    want = {}
    for dep, val, group, x in cells:
        want.setdefault(group, {})[f"{dep}.{'NA' if val is None else val}"] = x
    keys = sorted({k for v in want.values() for k in v})
    assert wide.columns == ["independent.var.value", *keys]
    assert {r[0]: list(r)[1:] for r in wide.collect()} == {g: [v.get(k) for k in keys] for g, v in want.items()}
