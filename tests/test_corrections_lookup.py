"""Correction log (J12) and first-match lookups."""

import pytest
from pyspark.sql import functions as F

from formsieve.operators import joins, lookup, reshape
from formsieve.operators.corrections import CHANGED, SAME, TRAIL_COLUMNS, UNPARSABLE, apply_log, change_trail, unapplied_entries, undo
from tests.conftest import rows
from tests.fixtures import admin_df, dictionary_df


def _data(spark):
    return spark.createDataFrame([("u1", "a", 10.0, 1), ("u2", "b", 20.0, 2), ("u3", "c", 30.0, 3)],
                                 "uuid string, name string, hh double, n int")


def _log(spark, entries):
    return spark.createDataFrame(entries, "uuid string, variable string, new_value string, change string, ord long")


def test_apply_log_cases(spark):
    log = _log(spark, [
        ("u1", "name", "A", "TRUE", 1),        # normal change
        ("u2", "name", "B", "FALSE", 2),       # refused
        ("u1", "hh", "11", "TRUE", 3),         # two entries for one cell: the later wins
        ("u1", "hh", "12", "TRUE", 4),
        ("u9", "name", "ghost", "TRUE", 5),    # unknown uuid
        ("u3", "nope", "x", "TRUE", 6),        # unknown variable
        ("u3", "n", "abc", "yes", 7),          # text into a number column: the cell stays
        ("u2", "hh", None, "yes", 8),          # emptied
    ])
    out = apply_log(_data(spark), log)
    assert rows(out) == [("u1", "A", 12.0, 1), ("u2", "b", None, 2), ("u3", "c", 30.0, 3)]
    bad = rows(unapplied_entries(_data(spark), log), "uuid", "reason")
    assert bad == [("u3", "unknown variable"), ("u3", "value does not parse"), ("u9", "unknown id")]
    trail = change_trail(_data(spark), log)
    assert trail.columns == ["uuid", *TRAIL_COLUMNS]
    assert rows(trail) == [("u1", "hh", "10.0", "12.0", "12", CHANGED), ("u1", "name", "a", "A", "A", CHANGED),
                           ("u2", "hh", "20.0", None, None, CHANGED), ("u3", "n", "3", "3", "abc", UNPARSABLE)]
    assert rows(undo(out, trail)) == rows(_data(spark))


def test_trail_takes_every_type_back(spark):
    df = spark.sql("""SELECT * FROM VALUES
        ('u1', 0.1D, 1e300D, 7, true, DATE'2024-02-29', TIMESTAMP'2024-01-02 03:04:05.678901', 1.50BD, array(1), 'x'),
        ('u2', NULL, -0.0D, NULL, false, NULL, NULL, NULL, NULL, NULL),
        ('u3', 3.0D, 2.0D, 3, NULL, DATE'1999-12-31', TIMESTAMP'1970-01-01 00:00:00', 2.25BD, array(2), '')
        AS t(uuid, a, b, i, f, d, t, m, l, s)""")
    new = {"a": "0.30000000000000004", "b": "5", "i": "9", "f": "false", "d": "2025-01-01", "t": "2025-01-01 10:00:00.000001", "m": "9.99",
           "l": "[3]", "s": "y"}
    log = _log(spark, [(u, k, v, "TRUE", 1) for u in ("u1", "u2", "u3") for k, v in new.items()])
    out = apply_log(df, log)
    trail = change_trail(df, log)
    assert [tuple(r)[1:3] for r in out.orderBy("uuid").collect()] == [(0.30000000000000004, 5.0)] * 3
    assert rows(out, "l") == rows(df, "l")  # a list has no text form that reads back: not written, but reported
    assert {(r["uuid"], r["variable"]) for r in unapplied_entries(df, log).collect()} == {(u, "l") for u in ("u1", "u2", "u3")}
    assert rows(trail.groupBy("outcome").count()) == [(CHANGED, 23), (SAME, 1)]
    assert rows(undo(out, trail)) == rows(df)


def test_undo_where_ids_repeat(spark):
    df = spark.createDataFrame([("u1", 1, "a"), ("u1", 2, "b"), ("u2", 3, "c")], "uuid string, row long, name string")
    log = _log(spark, [("u1", "name", "z", "TRUE", 1)])
    out = apply_log(df, log)
    assert rows(out, "name") == [("c",), ("z",), ("z",)]
    assert rows(undo(out, change_trail(df, log, row_id="row"), row_id="row")) == rows(df)
    with pytest.raises(Exception, match="undo needs row_id"):
        undo(out, change_trail(df, log)).collect()
    alike = df.withColumn("name", F.lit("a"))
    assert rows(undo(apply_log(alike, log), change_trail(alike, log))) == rows(alike)


def test_empty_log_is_identity(spark):
    empty = _log(spark, [])
    assert rows(apply_log(_data(spark), empty)) == rows(_data(spark))


def test_first_match_lookup_never_multiplies(spark):
    d = dictionary_df(spark)
    df = spark.createDataFrame([("mdf",), ("ngo_a",), ("zzz",), (None,)], "org string")
    out = lookup.lookup_first(df, "org", d, "label")
    assert rows(out) == [("mdf", "MDF first"), ("ngo_a", "NGO A"), ("zzz", None), (None, None)]


def test_list_scoped_lookup(spark):
    d = dictionary_df(spark)
    df = spark.createDataFrame([("mdf",)], "org string")
    assert lookup.lookup_first(df, "org", d, "label", list_name="ngo2").first()["label"] == "MDF second"


def test_frame_wide_map_and_join_paths_agree(spark):
    d = dictionary_df(spark)
    df = spark.createDataFrame([("u1", "yes", "adequate", 1.0), ("u2", "free text", None, 0.0), ("u3", "mdf", "no", 2.0)],
                               "uuid string, a string, b string, f double")
    by_map = lookup.label_columns(df, ["a", "b", "f"], d)
    by_join = lookup.label_columns_join(df, ["a", "b", "f"], d)
    assert rows(by_map) == rows(by_join)
    assert rows(by_map) == [("u1", "Yes", "Adequate", "Yes"), ("u2", None, None, "No"), ("u3", "MDF first", "No", None)]
    # the map path is a projection: no join in the plan
    assert "Join" not in by_map._jdf.queryExecution().optimizedPlan().toString()


def test_join_path_with_duplicated_ids(spark):
    d = dictionary_df(spark)
    df = spark.createDataFrame([("u1", "yes"), ("u1", "no"), ("u2", None)], "uuid string, a string")
    assert rows(lookup.label_columns_join(df, ["a"], d)) == [("u1", "No"), ("u1", "Yes"), ("u2", None)]
    # a dictionary larger than the literal limit takes the join path and agrees
    assert rows(lookup.label_columns(df, ["a"], d, max_entries=2)) == rows(lookup.label_columns(df, ["a"], d))


def test_icon_map_and_recode(spark):
    df = spark.createDataFrame([("adequate",), ("inadequate",), ("weird",)], "s string")
    out = lookup.map_values(df, ["s"], {"adequate": "green.png", "inadequate": "red.png"})
    assert [r[0] for r in out.collect()] == ["green.png", "red.png", None]
    df2 = spark.createDataFrame([("open_air",), ("x",), (None,)], "c string")
    assert [r[0] for r in df2.select(lookup.recode_value("c", "open_air", "open_defecation")).collect()] == \
        ["open_defecation", "x", None]


def test_admin_names_from_distinct_dimensions(spark):
    df = spark.createDataFrame([("u1", "YE11", "YE1101"), ("u2", "YE12", "YE9999")],
                               "uuid string, a1_governorate string, a2_district string")
    out = joins.add_admin_names(df, admin_df(spark), [
        ("admin1Pcode", "admin1Name_en", "a1_governorate", "gov_name"),
        ("admin2Pcode", "admin2Name_en", "a2_district", "dist_name")], constants={"country_id": "YE"})
    assert rows(out, "uuid", "gov_name", "dist_name", "country_id") == [("u1", "Ibb", "Ibb city", "YE"),
                                                                        ("u2", "Abyan", None, "YE")]


def test_anti_join_then_union_is_idempotent(spark):
    master = spark.createDataFrame([("u1", 1), ("u2", 2)], "uuid string, v int")
    batch = spark.createDataFrame([("u2", 20), ("u3", 3)], "uuid string, v int")
    once = reshape.union_fill([master, joins.new_rows_only(batch, master)])
    twice = reshape.union_fill([once, joins.new_rows_only(batch, once)])
    assert rows(once) == rows(twice) == [("u1", 1), ("u2", 2), ("u3", 3)]


def test_membership_report(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    other = spark.createDataFrame([(1,), (1,)], "k int")
    assert rows(joins.membership_report(df, "k", other)) == [(False, 2), (True, 1)]


def test_trimmed_master_lookup(spark):
    df = spark.createDataFrame([(" Camp A\t", "X1"), ("Camp B", "X2")], "name string, own string")
    master = spark.createDataFrame([("Camp A ", "M1", 1), ("Camp A", "M9", 2)], "site_name string, site_code string, o long")
    out = lookup.lookup_by_trimmed_name(df, "name", master, "mc", ord_col="o")
    assert rows(out.select("own", lookup.override_code("mc", "own"))) == [("X1", "M1"), ("X2", "X2")]


def test_attach_by_key_first_by_order(spark):
    log = spark.createDataFrame([("u1", "x")], "uuid string, issue string")
    data = spark.createDataFrame([("u1", "ngo_b", 2), ("u1", "ngo_a", 1)], "uuid string, org string, idx int")
    assert rows(joins.attach_by_key(log, data, "uuid", ["org"], "idx")) == [("u1", "x", "ngo_a")]


def test_row_id_is_a_total_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    assert rows(joins.with_row_id(df, ["k"]), "k", "row_id") == [("a", 1), ("b", 2), ("c", 3)]


def test_sort_nulls_first_is_stable(spark):
    from formsieve.operators.sitecodes import sort_nulls_first
    df = spark.createDataFrame([(None, "b", 1), ("x", None, 2), (None, "a", 3), (None, "a", 0)],
                               "code string, name string, o int")
    assert [r.o for r in sort_nulls_first(df, ["code", "name"], "o").collect()] == [0, 3, 1, 2]


def test_bucketed_dictionary_equals_flat(spark):
    import random
    rnd = random.Random(2)
    codes = [f"c{i}_{rnd.randint(0, 999)}" for i in range(300)] + ["1", "0"]
    d = spark.createDataFrame([(i, "l", c, f"L{i}") for i, c in enumerate(codes)] + [(999, "l", "c0_" , "dup")],
                              "ord long, list_name string, name string, label_english string")
    cells = spark.createDataFrame([(c,) for c in codes[::7]] + [("zzz",), (None,)], "a string") \
        .withColumn("n", F.lit(1.0))
    bucketed = lookup.dictionary_lookup(d)
    flat = lookup.dictionary_map(d)
    out = cells.select(bucketed(F.col("a")).alias("b"), F.try_element_at(flat, F.col("a")).alias("f")).collect()
    assert all(r.b == r.f for r in out) and sum(r.b is not None for r in out) == len(codes[::7])
    # numbers match their integral text
    assert cells.select(bucketed(F.lit("1"))).first()[0] == "L300"
