"""Unions over versions (U1, U2), wide tables of many keys (R2, R5), large dictionaries (J2), the
inspection's other kinds (D15, W5), codes over runs (N2) and the WASH rule (Q8)."""

import random
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formsieve.operators import checks, inspection, lookup, reshape, versions, wide
from formsieve.operators.sitecodes import assign_free_codes, free_ranges, used_numbers
from formsieve.plans import analysis, survey
from tests.conftest import rows

L, D, S, B, DAY, TS = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType()


@pytest.mark.parametrize("types,text,typed", [
    ([L, L], L, L), ([T.IntegerType(), L], L, L), ([L, D], D, D), ([T.FloatType(), T.DecimalType(9, 2)], D, D), ([DAY, TS], TS, TS),
    ([L, S], S, L), ([DAY, S, TS], S, TS), ([L, DAY], S, S), ([B, L], S, S), ([B, S], S, B), ([T.NullType(), L], L, L), ([T.NullType()], S, S)])
def test_common_types(types, text, typed):
    assert versions.common_type(types) == text and versions.common_type(types, "typed") == typed


def test_structures_join_only_with_themselves():
    a = T.ArrayType(L)
    assert versions.common_type([a, a]) == a
    with pytest.raises(ValueError, match="no common type"):
        versions.common_type([a, S])


def test_union_of_versions_and_its_rejects(spark):
    v1 = spark.createDataFrame([("a", 1, 1.5, date(2024, 1, 2), True)], "id string, n long, x double, day date, ok boolean")
    v2 = spark.createDataFrame([("b", " 7 ", "2.5", "2024-02-30", "maybe"), ("c", "7.0", "n/a", "2024-02-29", "true"), ("d", "1e3", None, "", None),
                                ("e", "9223372036854775807", "-0.5", None, "no"), ("f", "99999999999999999999", "1", "x", "no")],
                               "id string, n string, x string, day string, ok string")
    v3 = spark.createDataFrame([("g", 2.5, 4, datetime(2024, 5, 6)), ("h", 3.0, 5, datetime(2024, 5, 6, 7))], "id string, n double, x int, day timestamp_ntz")
    template = T.StructType([T.StructField("day", DAY), T.StructField("n", L)])
    out, rejects = versions.union_versions([v1, v2, v3], template, "id", on_text="typed")
    assert out.columns == ["day", "n", "id", "x", "ok"] and [f.dataType for f in out.schema] == [DAY, L, S, D, B]
    got = {r["id"]: (r["n"], r["x"], r["day"], r["ok"]) for r in out.collect()}
    assert got == {"a": (1, 1.5, date(2024, 1, 2), True), "b": (7, 2.5, None, None), "c": (7, None, date(2024, 2, 29), True), "d": (1000, None, None, None),
                   "e": (9223372036854775807, -0.5, None, False), "f": (None, 1.0, None, False), "g": (None, 4.0, date(2024, 5, 6), None), "h": (3, 5.0, None, None)}
    assert rejects.columns == versions.REJECT_COLUMNS
    assert {(r["part"], r["key"], r["variable"], r["value"]) for r in rejects.collect()} == {
        (2, "b", "day", "2024-02-30"), (2, "b", "ok", "maybe"), (2, "c", "x", "n/a"), (2, "d", "day", ""), (2, "f", "n", "99999999999999999999"),
        (2, "f", "day", "x"), (3, "g", "n", "2.5"), (3, "h", "day", "2024-05-06 07:00:00")}
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    text, none = versions.union_versions([v1, v2], key="id")
    assert none.count() == 0 and rows(text.filter("id = 'a'"), "n", "x", "day", "ok") == [("1", "1.5", "2024-01-02", "true")]


def test_a_bad_cell_doesnt_stop_the_template_union(spark):
    template = spark.createDataFrame([], "uuid string, n int")
    part = spark.createDataFrame([("a", "12"), ("b", "twelve")], "uuid string, n string")
    out = reshape.union_onto_template(template, [part, part.select("uuid").withColumn("extra", F.lit(1))])
    assert out.columns == ["uuid", "n", "extra"]
    assert rows(out) == [("a", 12, None), ("a", None, 1), ("b", None, 1), ("b", None, None)]


# ------------------------------------------------------------------ wide tables

def test_fifty_thousand_keys_round_trip(spark, tmp_path):
    """Beyond the columns that a single wide table may have."""
    n = 50_000
    assert n > reshape.MAX_WIDE_COLUMNS
    long = spark.range(n * 2).select((F.col("id") % 2).alias("g"), F.concat(F.lit("k"), F.expr("id div 2").cast("string")).alias("k"),
                                     F.col("id").cast("double").alias("v")).filter("g = 0 OR v % 3 != 0")
    wide.write_blocks(long, ["g"], "k", "v", f"{tmp_path}/w", block_columns=1_000)
    assert spark.read.parquet(f"{tmp_path}/w/keys").agg(F.max("block"), F.max("place")).first()[:] == (49, 999)
    back = wide.read_long(spark, f"{tmp_path}/w", ["g"], "k", "v")
    assert back.count() == long.count() and back.exceptAll(long).isEmpty()
    some = wide.read_keys(spark, f"{tmp_path}/w", ["k49999", "k0", "k17"], ["g"])
    assert some.columns == ["g", "k49999", "k0", "k17"] and rows(some) == [(0, 99998.0, 0.0, 34.0), (1, None, 1.0, 35.0)]
    block = wide.read_block(spark, f"{tmp_path}/w", 49, ["g"])
    assert len(block.columns) == 1_001 and block.columns[1:] == sorted(f"k{i}" for i in range(n))[-1_000:]
    assert block.filter("g = 0").first()["k9999"] == 19_998.0
    with pytest.raises(KeyError):
        wide.read_keys(spark, f"{tmp_path}/w", ["nope"], ["g"])


def test_wide_edge_cases(spark, tmp_path):
    schema = "g string, h int, `odd key` string, v double"
    df = spark.createDataFrame([("a", 1, "x, y", 1.0), (None, 2, "x, y", 2.0), ("a", None, "z=1", None), ("b", 3, None, 9.0)], schema)
    wide.write_blocks(df, ["g", "h"], "odd key", "v", f"{tmp_path}/a", block_columns=1)
    assert rows(wide.read_block(spark, f"{tmp_path}/a", 0, ["g", "h"])) == [("a", 1, 1.0), ("a", None, None), ("b", 3, None), (None, 2, 2.0)]
    assert rows(wide.read_long(spark, f"{tmp_path}/a", ["g", "h"])) == [("a", 1, "x, y", 1.0), (None, 2, "x, y", 2.0)]
    m = {(r["g"], r["h"]): r["cells"] for r in wide.spread_map(df, ["g", "h"], "odd key", "v").collect()}
    assert m == {("a", 1): {"x, y": 1.0}, (None, 2): {"x, y": 2.0}, ("a", None): {"z=1": None}}
    single = df.filter("v = 2")
    wide.write_blocks(single, ["g", "h"], "odd key", "v", f"{tmp_path}/s")
    assert rows(wide.read_keys(spark, f"{tmp_path}/s", ["x, y"], ["g", "h"])) == [(None, 2, 2.0)]
    twice = df.unionByName(df)
    for run in (lambda: wide.write_blocks(twice, ["g", "h"], "odd key", "v", f"{tmp_path}/t"), lambda: wide.spread_map(twice, ["g"], "odd key", "v").collect()):
        with pytest.raises(Exception, match="two results for one cell"):
            run()


# ------------------------------------------------------------------ dictionaries

def test_only_codes_that_occur_become_literals(spark):
    d = spark.range(3000).select(F.col("id").alias("ord"), F.concat(F.lit("c"), (F.col("id") % 1500).cast("string")).alias("name"),
                                 F.concat(F.lit("label "), F.col("id").cast("string")).alias("label_english"))
    df = spark.range(4000).select("id", F.concat(F.lit("c"), (F.col("id") % 40).cast("string")).alias("a"),
                                  F.when(F.col("id") % 3 > 0, F.concat(F.lit("c"), (F.col("id") % 2000).cast("string"))).alias("b"))
    want = rows(lookup.label_columns_join(df, ["a", "b"], d))
    few = lookup.label_columns(df.select("id", "a"), ["a"], d, max_entries=100)
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Join" not in plan and "Generate" not in plan
    assert rows(few) == sorted(((i, a) for i, a, _ in want), key=lambda t: tuple((x is None, str(x)) for x in t))
    assert lookup.occurring_pairs(df, ["a", "b"], d, max_entries=100) is None  # too many: the join path
    assert rows(lookup.label_columns(df, ["a", "b"], d, max_entries=100)) == want


# ------------------------------------------------------------------ inspection

def test_inspection_finds_free_text_and_sensitive_columns(spark):
    rng = random.Random(1)
    data = [(i, rng.choice([None, " tents", "tents", "", "soap "]), f"+967 77{i:07d}", f"p{i}@mail.example" if i % 3 else "-", f"{13 + i / 1000:.4f}, {44 + i / 999:.4f}",
             rng.choice(["7712345", "7754321"]), "x", float(i), "someone") for i in range(200)]
    df = spark.createDataFrame(data, "id long, `needs.other` string, q1 string, q2 string, q3 string, code string, another string, num double, contact_name string")
    found = inspection.findings(inspection.profile(df))
    assert found.columns == inspection.FINDINGS
    got = {(r["variable"], r["value"]): (r["n"], r["issue_type"]) for r in found.collect()}
    answers = Counter(r[1].strip() for r in data if r[1] is not None and r[1].strip())
    assert got == {**{("needs.other", a): (n, inspection.ISSUE_OTHER) for a, n in answers.items()},
                   **{(c, k): (200, inspection.ISSUE_SENSITIVE) for c, k in (("q1", "phone"), ("q2", "email"), ("q3", "coordinates"), ("contact_name", "name"))}}
    assert rows(inspection.without_kinds(found, ["Potentially sensitive", "may need recoding"])) == []
    # as the workflow that drops both kinds writes it
    assert inspection.without_kinds(found, ["Potentially sensitive information."]).count() == len(answers)


def test_profile_is_one_aggregate_with_moments(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (4.0, None)], "x double, t string")
    p = inspection.profile(df)
    got = {r["variable"]: r for r in p.collect()}
    assert got["x"]["mean"] == pytest.approx(7 / 3) and got["x"]["sd"] == pytest.approx(1.5275252316519468) and got["t"]["n"] == 2
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange ") == 1
    with pytest.raises(ValueError):
        inspection.profile(df.select(F.array("x").alias("l")))


# ------------------------------------------------------------------ codes over runs

def test_no_code_twice_over_three_runs(spark):
    rng = random.Random(3)
    held = spark.createDataFrame([("A_12",), ("A-13",), ("A_19",), ("B_10",), ("A_99",), (None,), ("odd",)], "code string")
    seen, n, short = Counter(r["code"].replace("-", "_") for r in held.collect() if r["code"]), 0, 0
    for run in range(3):
        data = [(None if rng.random() < 0.9 else f"A_{1000 + run}", rng.choice(["x", "y", None]), rng.choice(["A", "A", "B", None]), n + i) for i in range(12)]
        n += 12
        df = spark.createDataFrame(data, "code string, name string, d string, ord long")
        out, report = assign_free_codes(df, held, "code", "name", "d", "ord", 10, 20)
        got = out.collect()
        assert len(got) == 12
        new = [r for r in got if r["code"] is not None and not r["code"].startswith("A_1000") and int(r["code"].split("_")[1]) < 100]
        # lowest free numbers, in name order (nulls first), then row order
        for d in {r["d"] for r in new}:
            prefix = d or "NA"
            want = sorted([r for r in got if r["d"] == d and (r["code"] is None or r in new)], key=lambda r: (r["name"] is not None, r["name"] or "", r["ord"]))
            free = [k for k in range(10, 21) if f"{prefix}_{k}" not in seen]
            assert [r["code"] for r in want] == [f"{prefix}_{k}" for k in free[:len(want)]] + [None] * max(0, len(want) - len(free))
        lacking = Counter((r["d"] or "NA") for r in got if r["code"] is None)
        assert {r["district"]: r["n_without_code"] for r in report.collect()} == dict(lacking)
        short += sum(lacking.values())
        codes = [r["code"] for r in new]
        assert not set(codes) & set(seen) and len(codes) == len(set(codes))
        seen.update(codes)
        held = held.unionByName(spark.createDataFrame([(c,) for c in codes], "code string"))
    assert short  # the runs do exhaust a district


def test_gaps_between_used_numbers(spark):
    used = used_numbers(spark.createDataFrame([("A_5",), ("A_6",), ("A_9",), ("B_1",), ("A_5",)], "c string"), "c")
    d = spark.createDataFrame([("A",), ("C",)], "_district string")
    assert rows(free_ranges(used, d, 1, 10)) == [("A", 1, 4, 0), ("A", 10, 10, 6), ("A", 7, 8, 4), ("C", 1, 10, 0)]


# ------------------------------------------------------------------ rules and labels

def test_open_defecation_contradicts_adequate_wash(spark):
    columns = sorted({c for c in ("a7_site_population_hh", "c5_fuel_available_in_site_close_proximity", "c6_electricity_solar_power_available_in_site",
                                  "primary_cooking_modality", "a9_formal_informal", "c1_type_of_site", "c9_primary_shelter_type", "waste_disposal_services",
                                  "c10_primary_latrine_type", "wash_services", "c8_primary_water_source", "c3_tenancy_agreement_for_at_least_6_months")})
    def site(i, latrine, wash="adequate"):
        r = dict.fromkeys(columns) | {"c10_primary_latrine_type": latrine, "wash_services": wash}
        return (f"u{i}", "ngo", "site", *[r[c] for c in columns], 0)
    schema = "uuid string, q0_3_organization string, a4_site_name3 string, " + ", ".join(f"{c} string" for c in columns) + ", `f1_threats_to_the_site.eviction` int"
    df = spark.createDataFrame([site(0, "open_defecation"), site(1, "pit_latrine_open"), site(2, "open_air"), site(3, "open_defecation", "inadequate"),
                                site(4, None)], schema)
    hit = lambda rules: {r["uuid"] for r in checks.run_rules(df, rules, survey.SURVEY_CTX).filter("rule_id = 'adequate_wash_issue'").collect()}
    assert hit(survey.consistency_rules()) == {"u0", "u1"}
    assert hit(survey.consistency_rules(unsafe_latrines=survey.UNSAFE_LATRINES_AS_WRITTEN)) == {"u1", "u2"}


def test_collapsed_labels_are_reported_and_warned_of(spark):
    df = spark.createDataFrame([("a", "g"), ("b", "g"), ("c", "g")], "v string, g string")
    res = analysis.run_plan(df, [{"dependent.variable": "v", "dependent.variable.type": "categorical", "independent.variable": "g"}])
    d = lambda pairs: spark.createDataFrame([(i, n, x) for i, (n, x) in enumerate(pairs)], "ord long, name string, label_english string")
    with pytest.warns(UserWarning, match="indistinguishable"):
        lab, lost = analysis.labelled_with_report(res, d([("a", "same"), ("b", "same")]))
    assert lab.count() == 3 and rows(lost, "`dependent.var.value.label`", "n") == [("same", 2)]
    import warnings
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert analysis.labelled_with_report(res, d([("a", "one"), ("b", "two")]))[1].isEmpty()
