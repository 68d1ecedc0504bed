
from pyspark.sql import functions as F

from formsieve.functions.fmt import format_result
from formsieve.functions.nulls import na_if_else, num_to_text, paste, strict_sum
from formsieve.functions.text import (matches, minutes_of_day, normalise_cell, replace_all, replace_first, to_number,
                                      trim_ws)
from formsieve.operators.columns import match_columns


def test_if_else_keeps_na(spark):  # point 1
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    out = df.select(na_if_else(F.col("x") > 2, 1, 0).alias("f")).collect()
    assert [r.f for r in out] == [0, 1, None]


def test_filter_drops_na(spark):  # point 2
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert df.filter(na_if_else(F.col("x") == 1, 1, 0) == 1).count() == 1


def test_strict_sum_poisoned_by_na(spark):  # point 5
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 3.0)], "g string, x double")
    out = dict(df.groupBy("g").agg(strict_sum("x").alias("s")).collect())
    assert out == {"a": None, "b": 5.0}


def test_paste_prints_na(spark):  # point 7
    df = spark.createDataFrame([("YE11",), (None,)], "d string")
    assert [r[0] for r in df.select(paste(F.col("d"), "_", F.lit(1185))).collect()] == ["YE11_1185", "NA_1185"]


def test_round_half_even(spark):  # point 8
    df = spark.createDataFrame([(2.5,), (3.5,), (0.125,)], "x double")
    assert [r[0] for r in df.select(F.bround("x", 0)).collect()] == [2.0, 4.0, 0.0]


def test_trim_all_whitespace(spark):  # point 11
    df = spark.createDataFrame([(" \t name \n",), (None,)], "x string")
    assert [r[0] for r in df.select(trim_ws("x")).collect()] == ["name", None]


def test_contains_ignores_case(spark):  # point 12
    df = spark.createDataFrame([], "Food_Check int, water_CHECK int, other int")
    assert match_columns(df, contains="check") == ["Food_Check", "water_CHECK"]


def test_num_to_text_drops_point_zero(spark):
    df = spark.createDataFrame([(1.0,), (0.5,), (-0.0,), (None,)], "x double")
    assert [r[0] for r in df.select(num_to_text("x")).collect()] == ["1", "0.5", "0", None]


def test_text_to_number_is_ansi_safe(spark):
    df = spark.createDataFrame([("19",), ("abc",), (None,)], "x string")
    assert [r[0] for r in df.select(to_number("x")).collect()] == [19.0, None, None]


def test_replace_first_and_all(spark):
    df = spark.createDataFrame([("a_b_c",)], "x string")
    r = df.select(replace_first("x", "_", "-"), replace_all("x", "_", " - ")).first()
    assert tuple(r) == ("a-b_c", "a - b - c")


def test_normalise_cell(spark):
    df = spark.createDataFrame([("Hello World-1",)], "x string")
    assert df.select(normalise_cell("x")).first()[0] == "hello.world.1"


def test_regex_test_on_null_is_false(spark):  # W5: grepl(NA) is FALSE, the row stays
    df = spark.createDataFrame([("other response",), (None,)], "x string")
    assert df.filter(~matches("x", "other")).count() == 1


def test_minutes_of_day_ignores_fraction_and_offset(spark):
    df = spark.createDataFrame([("09:30:30.999+03:00",)], "t string")
    assert df.select(minutes_of_day("t")).first()[0] == 570.5


def test_format_percent_and_interval(spark):
    df = spark.createDataFrame([(0.4512, 0.40, 0.50, True, True), (0.0, 0.0, 0.0, True, True),
                                (12.346, None, None, False, False), (0.0, 0.0, 0.0, False, True)],
                               "n double, lo double, hi double, p boolean, h boolean")
    out = [r[0] for r in df.select(format_result("n", "lo", "hi", F.col("p"), F.col("h"))).collect()]
    assert out == ["45% (40%-50%)", "0%", "12.35 ", "0"]


def test_left_join_multiplies_rows(spark):  # point 4
    from formsieve.operators import joins
    admin = spark.createDataFrame([("YE11", "Ibb", "YE1101", "A"), ("YE11", "Ibb ", "YE1102", "B")],
                                  "admin1Pcode string, admin1Name_en string, admin2Pcode string, admin2Name_en string")
    df = spark.createDataFrame([("u1", "YE11")], "uuid string, a1 string")
    out = joins.add_admin_names(df, admin, [("admin1Pcode", "admin1Name_en", "a1", "gov")])
    assert out.count() == 2  # one code, two distinct names


def test_na_fill_only_numeric_result_columns(spark):  # point 10
    from formsieve.functions.nulls import fill_values
    df = spark.createDataFrame([("G1", None, None)], "g string, x double, label string")
    out = fill_values(df, 0.0, ["x"]).first()
    assert out["x"] == 0.0 and out["label"] is None
