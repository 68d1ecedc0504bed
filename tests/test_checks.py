"""Rule runner, duplicates, interview lengths, outliers and the survey preset."""

from pyspark.sql import functions as F

from formsieve.operators import checks
from formsieve.plans import survey
from tests.conftest import rows
from tests.fixtures import responses_df


def test_run_rules_one_scan_counts_equal_parts(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("b", 99.0, None), ("c", None, "y"), ("d", -5.0, "x")],
                               "uuid string, v double, s string")
    rules = [checks.range_rule("R1", "v", 0, 10, "out of range"),
             checks.Rule("R2", F.col("s") == "x", "s", "is x", "s")]
    log = checks.run_rules(df, rules, checks.LogContext("uuid", "s", "s"))
    assert log.columns == checks.LOG_COLUMNS
    assert log.count() == sum(df.filter(r.predicate).count() for r in rules)
    got = rows(log, "uuid", "rule_id", "old_value")
    assert got == [("a", "R2", "x"), ("b", "R1", "99"), ("d", "R1", "-5"), ("d", "R2", "x")]
    # the plan is a single scan with a generator, no exchange
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" in plan


def test_duplicates_exclude_null_keys(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b"), ("4", None), ("5", None)], "uuid string, k string")
    d = checks.duplicated_rows(df, "k")
    assert rows(d, "uuid", "freq") == [("1", 2), ("2", 2)]


def test_duration_issues(spark):
    df = spark.createDataFrame([
        ("a", "2020-10-01T09:00:10.1+03:00", "2020-10-01T09:03:40.9+03:00"),   # 3.5 min: short
        ("b", "2020-10-01T09:00:00.0+03:00", "2020-10-01T10:00:00.0+03:00"),   # 60: long
        ("c", "2020-10-01T09:00:00.0+03:00", "2020-10-01T09:20:00.0+03:00"),   # fine
        ("d", "2020-10-01T23:50:00.0+03:00", "2020-10-02T00:10:00.0+03:00"),   # next day: dropped
        ("e", None, "2020-10-01T09:00:00.0+03:00"), ("f", "20201001", "20201001")],
        "uuid string, start string, end string")
    got = rows(checks.duration_issues(df, 5, 40), "uuid", "value", "issue_type")
    assert got == [("a", 3.5, checks.SHORT_ISSUE), ("b", 60.0, checks.LONG_ISSUE)]


def test_duration_both_limits_gives_two_rows(spark):
    df = spark.createDataFrame([("a", "2020-10-01T09:00:00", "2020-10-01T09:10:00")], "uuid string, start string, end string")
    assert checks.duration_issues(df, 20, 5).count() == 2


def test_outliers_raw_scale(spark):
    vals = [(f"u{i}", 10.0 + (i % 3)) for i in range(40)] + [("big", 1000.0)]
    df = spark.createDataFrame(vals, "uuid string, x double")
    o = checks.outliers(df, "uuid", ["x"], k=3.0, log_scale=False)
    assert rows(o, "uuid", "issue_type") == [("big", checks.OUTLIER_NORMAL)]


def test_survey_raw_rules_against_python(spark):
    df = responses_df(spark)
    data = [r.asDict() for r in df.collect()]
    log = checks.run_rules(df.withColumn("a4_site_name3", F.col("a4_site_name")), survey.raw_rules(),
                           survey.SURVEY_CTX)
    counts = dict(log.groupBy("rule_id").count().collect())

    def n(pred):
        return sum(1 for r in data if pred(r))
    needs = survey.NEED_COLUMNS
    for flag, svc, need in survey.ADEQUACY_CHECKS:
        exp = n(lambda r: r[svc] == "adequate" and any(r[c] == need for c in needs))
        assert counts.get(flag, 0) == exp, flag
    assert counts.get("wrong_longitude", 0) == n(
        lambda r: r["a5_1_gps_longitude"] is not None and not (survey.LON_MIN <= r["a5_1_gps_longitude"] <= survey.LON_MAX))
    assert counts.get("exu_fb_wrong_number", 0) == n(
        lambda r: r["b3_exu_fp_mobile_number"] is not None and r["b3_exu_fp_mobile_number"][:2] not in survey.PHONE_PREFIXES)

    def hh(r):
        try:
            return float(r["a7_site_population_hh"])
        except (TypeError, ValueError):
            return None
    assert counts.get("less_than_20", 0) == n(lambda r: r["a9_formal_informal"] == "formal" and hh(r) is not None and hh(r) < 20)
    assert counts.get("eviction_issue", 0) == n(
        lambda r: r["c3_tenancy_agreement_for_at_least_6_months"] == "yes" and r["f1_threats_to_the_site.eviction"] == 1)

    def cooking_ok(r):
        a = r["c5_fuel_available_in_site_close_proximity"]
        b = r["c6_electricity_solar_power_available_in_site"]
        m = r["primary_cooking_modality"]
        # Kleene logic of (a == yes) | ((b == yes) & (m == Electrical)) | (m == Gas)
        def eq(x, v):
            return None if x is None else x == v
        def and_(x, y):
            if x is False or y is False:
                return False
            return None if x is None or y is None else True
        def or_(x, y):
            if x is True or y is True:
                return True
            return None if x is None or y is None else False
        return or_(or_(eq(a, "yes"), and_(eq(b, "yes"), eq(m, "Electrical_stove"))), eq(m, "Gas_stove"))
    assert counts.get("cooking_issue", 0) == n(lambda r: cooking_ok(r) is False)


def test_assemble_log_row_count_is_sum_of_parts(spark):
    df = responses_df(spark).withColumn("a4_site_name3", F.col("a4_site_name"))
    a = checks.run_rules(df, survey.gps_rules(), survey.SURVEY_CTX)
    b = checks.duplicate_log(df, "a4_site_name3", survey.ISSUE_DUPLICATE, survey.SURVEY_CTX)
    log = checks.assemble_log([a, b])
    assert log.count() == a.count() + b.count()
    assert all(t.dataType.simpleString() == "string" for t in log.schema.fields)


def test_duplicate_rule_in_a_rule_set_equals_duplicate_log(spark):
    # one key holds a third of the rows; null keys are never duplicates
    n = 300
    df = spark.range(n).select(
        F.col("id").cast("string").alias("uuid"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("s"), (F.col("id") % 40).cast("string"))).alias("site"),
        (F.col("id") % 5).cast("string").alias("org"),
        F.col("id").alias("v"))
    ctx = checks.LogContext(uuid="uuid", agency="org", area="site")
    want = rows(checks.duplicate_log(df, "site", "dup", ctx))
    flagged = checks.with_duplicate_flag(df, "site")
    assert flagged.count() == n  # the left join keeps every row once
    got = checks.run_rules(flagged, [checks.duplicate_rule("site", "dup"),
                                     checks.range_rule("R", "v", 0, 250, "range")], ctx)
    assert rows(got.filter(F.col("rule_id") == "Q1")) == want
    assert got.filter(F.col("rule_id") == "R").count() == n - 251
    assert ("hot",) in {(r[0],) for r in got.select("old_value").distinct().collect()}
