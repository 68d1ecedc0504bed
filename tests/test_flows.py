"""End-to-end survey flows on the seeded fixtures."""

import tempfile

from pyspark.sql import functions as F

from formsieve.plans import flows, survey
from formsieve.sources import io
from tests.conftest import rows
from tests.fixtures import admin_df, dictionary_df, responses_df, EXTERNAL_ROWS


def _external(spark):
    data = [(i + 1, *r) for i, r in enumerate(EXTERNAL_ROWS)]
    return spark.createDataFrame(data, "ord long, list_name string, name string, label_english string")


def test_raw_checks_tables(spark):
    out = flows.raw_checks(responses_df(spark), _external(spark), outlier_cols=["a5_1_gps_longitude"])
    log = out["cleaning_log"]
    assert log.columns[:9] == io.ISSUE_LOG_COLUMNS
    ids = {r.rule_id for r in log.select("rule_id").distinct().collect()}
    assert {"Q1", "wrong_longitude", "cooking_issue", "Q12_DUP"} <= ids
    # personal columns are gone before any check
    assert "deviceid" not in out["service_adequacy"].columns
    # site names resolved: first label of the code, else the free text
    names = {r.a4_site_name3 for r in out["service_adequacy"].select("a4_site_name3").collect()}
    assert "Al Amal camp" in names and "dup label" not in names
    lengths = out["survey_length"]
    assert lengths.filter(~F.col("issue_type").isin("form duration too short", "form duration too long")).count() == 0


def test_write_run_layout(spark):
    base = tempfile.mkdtemp(prefix="formsieve-run-")
    tables = {"cleaning_log": spark.createDataFrame([("u1",)], "uuid string"),
              "Survey length": spark.createDataFrame([(1,)], "x int")}
    paths = flows.write_run(tables, base, "2026-01-02")
    assert paths["Survey length"].endswith("run_date=2026-01-02/survey_length")
    assert io.read_sheet(spark, f"{base}/run_date=2026-01-02", "cleaning_log").count() == 1


def test_apply_and_publish(spark):
    resp = responses_df(spark)
    log = spark.createDataFrame([("u0001", "b1_site_management", "no", "TRUE", 1)],
                                "uuid string, variable string, new_value string, change string, ord long")
    out = flows.apply_and_publish(resp, log, dictionary_df(spark), _external(spark), admin_df(spark))
    clean = out["clean"]
    assert clean.filter(F.col("uuid") == "u0001").first()["b1_site_management"] == "no"
    assert "a1_governorate_code" in clean.columns and "a1_governorate_name" in clean.columns
    assert "start" not in out["internal"].columns and "q0_3_organization" not in out["external"].columns
    dash = out["dashboard"]
    assert "_uuid" in dash.columns
    # coded answers are labelled; cells without a code keep their text by default
    assert {r[0] for r in dash.select("b1_site_management").collect()} <= {"Yes", "No", "Don't know", None}
    assert {r[0] for r in dash.select("c1_type_of_site").collect()} == {"collective_centre", "spontaneous_settlement"}
    strict = flows.apply_and_publish(resp, log, dictionary_df(spark), _external(spark), admin_df(spark),
                                     strict_reference=True)["dashboard"]
    assert {r[0] for r in strict.select("c1_type_of_site").collect()} == {None}


def test_append_master_codes_unique(spark):
    name = F.col("a4_site_name")
    resp = responses_df(spark, 60).withColumns({
        "a2_district_code": F.col("a2_district"),
        "a4_site_name": F.when(name == "site_b", " Bab camp\t").when(name == "site_a", "Al Amal camp").otherwise(name)})
    master = resp.filter(F.col("index") < 30)
    batch = resp.filter(F.col("index") >= 20)
    site_master = spark.createDataFrame([("Bab camp", "YE_MASTER_1")], "site_name string, site_code string")
    out = flows.append_master(master, [batch], None, _external(spark), site_master, ord_col="index")
    assert out.count() == 60  # 30 master rows + the 30 batch rows whose uuid is new
    codes = out.filter(~F.col("a4_site_name").isin("Al Amal camp", "Bab camp")).select("a4_site_code", "index")
    numbered = [r[0] for r in codes.collect()]
    assert len(numbered) == len(set(numbered))
    assert out.filter(F.col("a4_site_name") == "Bab camp").select("a4_site_code").distinct().collect()[0][0] == "YE_MASTER_1"


def test_indicators_flow(spark):
    resp = responses_df(spark, 120)
    plan = [{"dependent.variable": "c1_type_of_site", "independent.variable": "a1_governorate_name"},
            {"dependent.variable": "b1_site_management", "independent.variable": "a1_governorate_name"}]
    out = flows.indicators(resp, dictionary_df(spark), _external(spark), plan, label_first=20, label_last=40)
    cols = out.columns
    assert "governorate" in cols and "tot_sites" in cols and "@map" in cols
    assert all(c == c.lower() for c in cols)
    assert out.select("governorate").distinct().count() == 3
    national = flows.indicators(resp.withColumn("country_name", F.lit("Yemen")), dictionary_df(spark),
                                _external(spark), [{"dependent.variable": "b1_site_management",
                                                    "independent.variable": "country_name"}],
                                group_col="country_name", formal_only=True, label_first=20, label_last=40)
    assert national.select("governorate").distinct().count() == 1


def test_update_checks(spark):
    resp = responses_df(spark).withColumn("a3_sub_district_name", F.col("a3_sub_district"))
    log = flows.update_checks(resp)
    ids = {r[0] for r in log.select("rule_id").distinct().collect()}
    assert "wrong_longitude" not in ids and "Q1" in ids


def test_site_merge_table(spark):
    resp = responses_df(spark).withColumn("a3_sub_district_code", F.col("a3_sub_district"))
    out = flows.site_merge_table(resp, dictionary_df(spark), ["c1_type_of_site", "b1_site_management", "x_other"],
                                 ["a1_governorate_name", "a4_site_name"])
    assert "@food_distribution" in out.columns and "@maps" in out.columns and "x_other" not in out.columns
    assert out.filter(F.col("a4_site_name") != F.trim("a4_site_name")).count() == 0
    icons = {r[0] for r in out.select("@food_distribution").collect()}
    assert icons <= set(survey.STATUS_ICONS.values())
