"""The engine's operators bound to the driver's star-schema tables.

The survey columns (site names, services, needs ...) do not exist in these tables, so
each query maps the operator's parameters to columns of the same kind: codes, flags,
numbers and text.  Where an operator needs an input the tables do not have as such (a
correction log, an ISO start/end pair, a padded name) a small ``_stand_in`` step derives
rows in the expected schema from the tables; the operator itself then does all the work
through the library.  Every query reads whole tables.
"""

from __future__ import annotations

import uuid as _uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formsieve.functions.fmt import blank_interval, format_results, pct100
from formsieve.functions.nulls import col, fill_values, na_if_else, paste, strict_sum
from formsieve.functions.text import normalise_cell, replace_all, replace_first, to_number, trim_ws, matches
from formsieve.operators import aggregate as agg
from formsieve.operators import checks
from formsieve.operators import columns as cols
from formsieve.operators import joins
from formsieve.operators import lookup
from formsieve.operators import reshape
from formsieve.operators.corrections import apply_log as _apply_log
from formsieve.operators.sitecodes import assign_site_codes, dashed_code, final_code
from formsieve.plans import analysis, survey
from formsieve.session import checkpoint_dir
from formsieve.sources import io

# ------------------------------------------------------------------ fixed values
# Issue texts of the rules bound to the driver tables.
ISSUE_RANGE = "The value provided may contain errors"
ISSUE_CROSS = "Answers contradict each other"
ISSUE_ADEQUACY = survey.ISSUE_ADEQUACY
ADEQUACY_VARIABLE = survey.ADEQUACY_VARIABLE
ISSUE_PREFIX = survey.ISSUE_PHONE
ISSUE_DUPLICATE = survey.ISSUE_DUPLICATE

# A code dictionary for the driver tables' codes, in file order (``ord`` = position).
# Codes repeat across lists ('F', 'O'), so a frame-wide lookup takes the first row.
CODE_DICTIONARY = [
    ("status", "F", "Fulfilled"),
    ("status", "O", "Open"),
    ("status", "P", "Partial"),
    ("linestatus", "F", "Final"),
    ("linestatus", "O", "Outstanding"),
    ("flag", "A", "Accepted"),
    ("flag", "R", "Returned"),
    ("priority", "1-URGENT", "Urgent"),
    ("priority", "2-HIGH", "High"),
    ("priority", "3-MEDIUM", "Medium"),
    ("priority", "4-NOT SPECIFIED", "Not specified"),
    ("yes_no", "1", "Yes"),
    ("yes_no", "0", "No"),
    ("line", "2", "Second line"),
    ("line", "3", "Third line"),
    ("line", "1", "First line"),
]

# Status -> icon table of the per-site merge.
STATUS_ICONS = survey.STATUS_ICONS

# Analysis plans bound to lineitem x supplier (direct reporting, categorical).
PLAN_SHARES = [
    {"Indicator": "Return flag", "dependent.variable": "l_returnflag", "dependent.variable.type": "categorical",
     "independent.variable": "s_nationkey", "independent.variable.type": "categorical",
     "repeat.for.variable": None, "hypothesis.type": "direct_reporting"},
    {"Indicator": "Line status", "dependent.variable": "l_linestatus", "dependent.variable.type": "categorical",
     "independent.variable": "s_nationkey", "independent.variable.type": "categorical",
     "repeat.for.variable": None, "hypothesis.type": "direct_reporting"},
    {"Indicator": "Line number", "dependent.variable": "l_linenumber", "dependent.variable.type": "categorical",
     "independent.variable": "s_nationkey", "independent.variable.type": "categorical",
     "repeat.for.variable": None, "hypothesis.type": "direct_reporting"},
]
PLAN_REPEAT = [
    {"Indicator": "Line status by flag", "dependent.variable": "l_linestatus", "dependent.variable.type": "categorical",
     "independent.variable": "s_nationkey", "independent.variable.type": "categorical",
     "repeat.for.variable": "l_returnflag", "hypothesis.type": "direct_reporting"},
]
PLAN_NUMERIC = [
    {"Indicator": "Mean price", "dependent.variable": "l_extendedprice", "dependent.variable.type": "numerical",
     "independent.variable": "s_nationkey", "independent.variable.type": "categorical",
     "repeat.for.variable": None, "hypothesis.type": "direct_reporting"},
]

# Column policies and version map bound to the customer table.
CUSTOMER_POLICIES = {"external": ["c_acctbal", "c_phone", "c_comment"]}
CUSTOMER_V1_TO_V2 = {"c_name": "customer_name", "c_mktsegment": "segment", "c_address": "address"}

ROUND_DIGITS = 6


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _round(c, digits: int = ROUND_DIGITS):
    return F.bround(col(c), digits)


def _money(c):
    """Exact money sums: decimal(18,2) inside, double outside."""
    return col(c).cast("decimal(18,2)")


# ------------------------------------------------------------------ stand-in inputs

def _stand_in_lineitem_orders(spark, sf) -> DataFrame:
    """Line items with their order's status and priority; ``nullif`` adds unknown answers."""
    li = _t(spark, sf, "lineitem")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.withColumns({
        "uuid": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "agency": col("l_suppkey").cast("string"),
        "status2": F.expr("nullif(o_orderstatus, 'P')"),
        "prio2": F.expr("nullif(o_orderpriority, '3-MEDIUM')"),
    })


LINE_CTX = checks.LogContext(uuid="uuid", agency="agency", area="l_returnflag")


def _range_rules() -> list[checks.Rule]:
    return [checks.range_rule("R_QTY", "l_quantity", 5, 45, ISSUE_RANGE),
            checks.range_rule("R_DISC", "l_discount", 0.01, 0.09, ISSUE_RANGE)]


def _cross_rules() -> list[checks.Rule]:
    c = F.col
    return [
        checks.Rule("X_Q5", (c("o_orderstatus") == "F") & (c("l_quantity") < 5), "l_quantity", ISSUE_CROSS,
                    "l_quantity"),
        checks.Rule("X_Q6", (c("l_returnflag") == "R") & checks.in_set("o_orderpriority", ["1-URGENT", "2-HIGH"]),
                    "o_orderpriority", ISSUE_CROSS, "o_orderpriority"),
        checks.Rule("X_Q7", (c("status2") == "O") & (c("l_linestatus") == "F"), "l_linestatus", ISSUE_CROSS,
                    "l_linestatus"),
        checks.Rule("X_Q9", (c("prio2") == "1-URGENT") & (c("l_tax") == 0), "l_tax", ISSUE_CROSS, "l_tax"),
        checks.Rule("X_Q10", ~((c("status2") == "F") | ((c("l_returnflag") == "N") & (c("l_linestatus") == "O"))
                               | (c("prio2") == "5-LOW")), "o_orderstatus", ISSUE_CROSS, "o_orderstatus"),
    ]


def rule_range(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity and discount outside a box; one log row per bad column."""
    li = _t(spark, sf, "lineitem").withColumns({
        "uuid": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "agency": col("l_suppkey").cast("string")})
    return checks.run_rules(li, _range_rules(), LINE_CTX)


def rule_cross_field(spark: SparkSession, sf: str) -> DataFrame:
    """Contradictory answer combinations in one scan."""
    return checks.run_rules(_stand_in_lineitem_orders(spark, sf), _cross_rules(), LINE_CTX)


def _adequacy_frame(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders")
    c = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return j.withColumns({"uuid": col("o_orderkey").cast("string"), "agency": col("o_custkey").cast("string"),
                          "status2": F.expr("nullif(o_orderstatus, 'P')"),
                          "prio2": F.expr("nullif(o_orderpriority, '3-MEDIUM')")})


ADEQUACY_NEEDS = ["o_orderpriority", "c_mktsegment", "status2"]


def _adequacy_rules() -> list[checks.Rule]:
    needs = ADEQUACY_NEEDS
    return [
        checks.Rule("urgent_check", (F.col("o_orderstatus") == "F") & checks.any_equals(needs, "1-URGENT"), "", ""),
        checks.Rule("building_check", (F.col("status2") == "F") & checks.any_equals(needs, "BUILDING"), "", ""),
        checks.Rule("high_check", (F.col("o_orderstatus") == "O") & checks.any_equals(needs, "2-HIGH"), "", ""),
        checks.Rule("machinery_check", (F.col("prio2") == "1-URGENT") & checks.any_equals(needs, "MACHINERY"), "", ""),
    ]


def rule_adequacy(spark: SparkSession, sf: str) -> DataFrame:
    """Wide flag table, pattern-selected flag columns melted, flag == 1 kept."""
    wide = checks.rule_flags(_adequacy_frame(spark, sf), _adequacy_rules(),
                             ["uuid", "agency", "c_mktsegment", "o_orderpriority"])
    flags = cols.select_matching(wide, keep=["uuid", "agency", "c_mktsegment"], contains="check")
    long = reshape.melt(flags, ["uuid", "agency", "c_mktsegment"], var_name="rule_id", value_name="old_value")
    hit = long.filter(F.col("old_value") == 1)
    return hit.select("uuid", "agency", F.col("c_mktsegment").alias("area"),
                      F.lit(ADEQUACY_VARIABLE).alias("variable"), F.lit(ISSUE_ADEQUACY).alias("issue"),
                      "old_value", F.lit(checks.DEFAULT_NEW_VALUE).alias("new_value"),
                      F.lit(checks.DEFAULT_FIX).alias("fix"), F.lit(checks.DEFAULT_CHECKED_BY).alias("checked_by"),
                      "rule_id")


PART_CTX = checks.LogContext(uuid="p_partkey", agency="p_type", area="p_name")


def _part_with_nulls(spark, sf) -> DataFrame:
    return _t(spark, sf, "part").withColumn("brand2", F.expr("nullif(p_brand, 'Brand#5')"))


def rule_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """A present code not starting with an allowed prefix."""
    rules = [checks.prefix_rule("Q4_BRAND", "brand2", ["Brand#1", "Brand#2"], ISSUE_PREFIX)]
    return checks.run_rules(_part_with_nulls(spark, sf), rules, PART_CTX)


def dup_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Every part whose name occurs more than once, with the frequency."""
    d = checks.duplicated_rows(_t(spark, sf, "part"), "p_name", "freq")
    return d.select("p_partkey", "p_name", F.col("freq").cast("long").alias("freq"))


def _stand_in_interviews(spark, sf) -> DataFrame:
    """Events as interviews: start = event time, end = start + ``value`` minutes (whole
    seconds), both as ISO text with an offset suffix, as forms record them.  The times
    stay wall-clock (``timestamp_ntz``), so no session time zone enters."""
    e = _t(spark, sf, "events")
    ts = F.col("ts").cast("timestamp_ntz")
    end = F.timestamp_add("SECOND", F.floor(F.col("value") * 60), ts)
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSS'+03:00'"
    return e.select(F.col("event_id").alias("uuid"), F.date_format(ts, fmt).alias("start"),
                    F.date_format(end, fmt).alias("end"))


def duration_check(spark: SparkSession, sf: str) -> DataFrame:
    """Same-day interviews of <= 5 or >= 40 minutes."""
    return checks.duration_issues(_stand_in_interviews(spark, sf), 5, 40)


OUTLIER_COLS = ["l_extendedprice", "l_quantity"]


def outliers(spark: SparkSession, sf: str) -> DataFrame:
    """Values outside mean +- 3 sd, raw and log scale."""
    li = _t(spark, sf, "lineitem").withColumn("uuid", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return checks.outliers(li, "uuid", OUTLIER_COLS, 3.0, True)


def issue_log(spark: SparkSession, sf: str) -> DataFrame:
    """The assembled 9-column log (+ rule id).  All line-item row rules
    run in one scan of line items x orders; the duplicate and prefix rules of parts in
    one scan of parts joined with their key counts; outliers and adequacy rules add
    their parts."""
    li = _stand_in_lineitem_orders(spark, sf)
    row_rules = checks.run_rules(li, _range_rules() + _cross_rules(), LINE_CTX)
    # duplicates and the prefix rule in one scan of parts (after the key-count aggregate)
    part = checks.with_duplicate_flag(_part_with_nulls(spark, sf), "p_name")
    part_rules = checks.run_rules(part, [
        checks.duplicate_rule("p_name", ISSUE_DUPLICATE),
        checks.prefix_rule("Q4_BRAND", "brand2", ["Brand#1", "Brand#2"], ISSUE_PREFIX)], PART_CTX)
    out = checks.outlier_log(_t(spark, sf, "lineitem").withColumns({
        "uuid": F.concat_ws("-", "l_orderkey", "l_linenumber"), "agency": col("l_suppkey").cast("string")}),
        OUTLIER_COLS, LINE_CTX)
    return checks.assemble_log([part_rules, rule_adequacy(spark, sf), row_rules, out])


# ------------------------------------------------------------------ lookups and joins

def _stand_in_part_dictionary(spark, sf) -> DataFrame:
    """A dictionary with repeated codes (built in one scan): part names listed under
    their type (small parts) and under their brand (large parts), ``ord`` = part key."""
    p = _t(spark, sf, "part")
    size = F.col("p_size")
    entries = [
        F.when(size <= 10, F.struct(F.col("p_partkey").alias("ord"), F.lit("p_type").alias("list_name"),
                                    F.col("p_type").alias("name"), F.col("p_name").alias("label_english"))),
        F.when(size > 45, F.struct(F.col("p_partkey").alias("ord"), F.lit("p_brand").alias("list_name"),
                                   F.col("p_brand").alias("name"), F.col("p_name").alias("label_english"))),
    ]
    return p.select(F.inline_outer(F.array(*entries))).filter(F.col("list_name").isNotNull())


def lookup_first(spark: SparkSession, sf: str) -> DataFrame:
    """First-match label per code inside one list; unmatched -> null."""
    d = _stand_in_part_dictionary(spark, sf)
    p = _t(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    out = lookup.lookup_first(p, "p_type", d, "type_label", list_name="p_type")
    out = lookup.lookup_first(out, "p_brand", d, "brand_label", list_name="p_brand")
    return out.select("p_partkey", "type_label", "brand_label")


def code_dictionary(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, ln, n, lab) for i, (ln, n, lab) in enumerate(CODE_DICTIONARY)]
    return spark.createDataFrame(rows, "ord long, list_name string, name string, label_english string")


LABELLED = ["o_orderstatus", "o_orderpriority", "l_returnflag", "l_linestatus", "line_code"]


def lookup_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Every coded cell of a column range replaced by its first-match label
    (list ignored); numbers match as text without ``.0``; unmatched -> null."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey).drop("o_orderkey") \
        .withColumn("line_code", F.col("l_linenumber").cast("double"))
    rng = cols.column_range(j, "l_returnflag", "line_code")
    return lookup.label_columns(j, rng, code_dictionary(spark)).select("l_orderkey", "l_linenumber", *LABELLED)


def _stand_in_customer_regions(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Customers carrying both admin codes (region, nation), and an admin list with one
    row per nation (regions repeat, as levels do in an admin list)."""
    n = _t(spark, sf, "nation")
    r = _t(spark, sf, "region")
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    data = c.join(n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("c_regionkey")),
                  "c_nationkey", "left")
    admin = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("r_regionkey").alias("admin1Pcode"), F.col("r_name").alias("admin1Name_en"),
        F.col("n_nationkey").alias("admin2Pcode"), F.col("n_name").alias("admin2Name_en"))
    return data, admin


def dim_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """Admin names joined level by level from distinct dimensions,
    plus country constants."""
    data, admin = _stand_in_customer_regions(spark, sf)
    out = joins.add_admin_names(data, admin, [
        ("admin1Pcode", "admin1Name_en", "c_regionkey", "region_name"),
        ("admin2Pcode", "admin2Name_en", "c_nationkey", "nation_name")],
        constants={"country_name": "World", "country_id": "WD"})
    return cols.select_cols(out, ["c_custkey", "c_regionkey", "region_name", "c_nationkey", "nation_name",
                                  "country_name", "country_id"])


def _stand_in_correction_log(spark, sf) -> DataFrame:
    """An edited log over customers (built in one scan): normal changes, a refused
    change, two entries for one cell, text into a number column, an unknown variable
    and unknown ids."""
    c = _t(spark, sf, "customer")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")

    def entry(cond, variable, new_value, change, n, uuid=None):
        return F.when(cond, F.struct((uuid if uuid is not None else k.cast("string")).alias("uuid"),
                                     F.lit(variable).alias("variable"), F.lit(new_value).alias("new_value"),
                                     F.lit(change).alias("change"), (k * 10 + n).alias("ord")))
    entries = [
        entry(seg == "BUILDING", "c_acctbal", "0", "TRUE", 1),
        entry(F.col("c_acctbal") < 0, "c_mktsegment", "DEBT", "yes", 2),
        entry(seg == "FURNITURE", "c_name", "refused", "FALSE", 3),
        entry(seg == "HOUSEHOLD", "c_acctbal", "1", "TRUE", 4),
        entry(seg == "HOUSEHOLD", "c_acctbal", "2", "TRUE", 5),
        entry(seg == "MACHINERY", "c_acctbal", "abc", "TRUE", 6),
        entry(seg == "MACHINERY", "c_phone", "555", "TRUE", 7),
        entry(seg == "AUTOMOBILE", "c_nationkey", "99", "TRUE", 8),
        entry(seg == "AUTOMOBILE", "c_name", "ghost", "TRUE", 9, F.concat(F.lit("x"), k.cast("string"))),
    ]
    return c.select(F.inline_outer(F.array(*entries))).filter(F.col("variable").isNotNull())


def apply_log(spark: SparkSession, sf: str) -> DataFrame:
    """The edited log applied in one join."""
    c = _t(spark, sf, "customer")
    out = _apply_log(c.withColumnRenamed("c_custkey", "uuid"), _stand_in_correction_log(spark, sf))
    return out.withColumnRenamed("uuid", "c_custkey")


def _stand_in_padded_sites(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Suppliers named after their nation with stray whitespace; a master list of
    nation names with codes for the first three regions."""
    n = _t(spark, sf, "nation")
    s = _t(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    data = s.join(n.select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey", "left") \
        .select("s_suppkey", F.concat(F.lit(" \t"), F.col("n_name"), F.lit("\n ")).alias("site_name"),
                F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("own_code"))
    master = n.filter(F.col("n_regionkey") < 3).select(
        F.col("n_name").alias("site_name"), F.concat(F.lit("M"), F.col("n_nationkey").cast("string")).alias("site_code"),
        F.col("n_nationkey").alias("ord"))
    return data, master


def override_code(spark: SparkSession, sf: str) -> DataFrame:
    """Master code by trimmed name, else the own code."""
    data, master = _stand_in_padded_sites(spark, sf)
    j = lookup.lookup_by_trimmed_name(data, "site_name", master, "master_code", ord_col="ord")
    return j.select("s_suppkey", trim_ws("site_name").alias("site_name"),
                    final_code("master_code", "own_code").alias("site_code"),
                    lookup.label_or_text("master_code", "site_name").alias("code_or_name"))


def recode_derive(spark: SparkSession, sf: str) -> DataFrame:
    """Filter, legacy recode, derived not-applicable indicator."""
    o = _t(spark, sf, "orders").filter(F.col("o_orderpriority") != "5-LOW")
    o = o.withColumn("status_in", F.expr("nullif(o_orderstatus, 'O')"))
    recoded = lookup.recode_value("status_in", "P", "PARTIAL")
    evict = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("1")).otherwise(F.lit("0"))
    derived = na_if_else((F.col("status_in") == "F") & (evict == "1"), "1", "0")
    derived = F.when(F.col("status_in") == "P", F.lit(None).cast("string")).when(F.col("status_in") != "P", derived)
    out = o.select("o_orderkey", recoded.alias("status_recoded"), derived.alias("agreement_with_issue"))
    out = out.withColumn("is_missing", F.col("agreement_with_issue").isNull())
    filled = out.fillna("not_applicable", subset=["status_recoded", "agreement_with_issue"])
    return filled


def _stand_in_batches(spark, sf):
    o = _t(spark, sf, "orders")
    master = o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp"))
    batch1 = o.filter(F.col("o_orderstatus") == "F")
    batch2 = o.filter(F.col("o_orderpriority") == "1-URGENT").drop("o_orderpriority") \
        .withColumn("kobo_version", F.lit("V2"))
    return o, master, batch1, batch2


def append_new(spark: SparkSession, sf: str) -> DataFrame:
    """New rows of two batches (anti-join on the key), stacked by
    name onto an empty template that fixes order and types, appended to the master."""
    o, master, b1, b2 = _stand_in_batches(spark, sf)
    new = reshape.union_fill([joins.new_rows_only(b1, master, "o_orderkey"),
                              joins.new_rows_only(b2, master, "o_orderkey")])
    schema = T.StructType(o.schema.fields + [T.StructField("kobo_version", T.StringType())])
    template = io.template_frame(spark, schema)
    return reshape.union_onto_template(template, [master, new])


def membership(spark: SparkSession, sf: str) -> DataFrame:
    """Which event users are customers - the distinct membership values, counted."""
    e = _t(spark, sf, "events").select("user_id")
    c = _t(spark, sf, "customer").select("c_custkey")
    return joins.membership_report(e, "user_id", c, "c_custkey")


def _stand_in_sites(spark, sf) -> DataFrame:
    """Customers as sites: a code only for three segments, a site name (nullable), a
    district code (nullable)."""
    c = _t(spark, sf, "customer")
    return c.select(
        "c_custkey",
        F.when(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY"),
               F.concat(F.lit("C_"), F.col("c_custkey").cast("string"))).alias("site_code"),
        F.expr("nullif(cast(c_nationkey as string), '3')").alias("site_name"),
        F.expr("nullif(substring(c_mktsegment, 1, 3), 'HOU')").alias("district_code"))


def site_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Codes for sites without one, numbered from 1185 in name order."""
    coded = assign_site_codes(_stand_in_sites(spark, sf), "site_code", "site_name", "district_code", "c_custkey")
    return coded.select("c_custkey", dashed_code("site_code").alias("site_code"))


# ------------------------------------------------------------------ aggregations

def _orders_customers(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders")
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "inner")


def group_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and strict sums (text -> number; one bad value poisons)."""
    j = _orders_customers(spark, sf).withColumn(
        "price_text", F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
                             & (F.col("o_totalprice") > 480000), F.lit("abc"))
        .otherwise(F.col("o_totalprice").cast("string")))
    g = ["c_nationkey", "c_mktsegment"]
    out = agg.drop_null_keys(j, g).groupBy(*g).agg(
        F.count(F.lit(1)).alias("n_orders"),
        strict_sum(to_number("price_text").cast("decimal(18,2)")).cast("double").alias("tot_price"),
        strict_sum(_money("o_totalprice")).cast("double").alias("tot_clean"))
    return out


def _weights(spark, sf) -> DataFrame:
    return _orders_customers(spark, sf).withColumn(
        "w", F.floor(F.col("o_totalprice") / 100000).cast("string"))


def weighted_mode(spark: SparkSession, sf: str) -> DataFrame:
    """Per nation the segment with the largest weight sum; ties kept."""
    return agg.weighted_mode(_weights(spark, sf), "c_nationkey", "c_mktsegment", "w", "most_segment")


def mode_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    """Most frequent event type per user; ties go to the type seen first."""
    e = _t(spark, sf, "events")
    return agg.mode_first_seen(e, "user_id", "event_type", "event_id", "mode")


def indicator_join(spark: SparkSession, sf: str) -> DataFrame:
    """Per-nation indicators joined in a left chain; tied modes fan out.  The
    two weighted modes come from one pass (``weighted_modes``)."""
    w = _weights(spark, sf)
    counts = agg.group_count(w, "c_nationkey", "n_orders").withColumn("n_orders", F.col("n_orders").cast("long"))
    modes = agg.weighted_modes(w, "c_nationkey", [("c_mktsegment", "w", "most_segment"),
                                                  ("o_orderpriority", "w", "most_priority")])
    return joins.join_chain([counts] + agg.modes_by_indicator(modes, "c_nationkey", ["most_segment", "most_priority"]),
                            "c_nationkey")


# ------------------------------------------------------------------ analysis plans

def _lineitem_suppliers(spark, sf) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    s = _t(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return li.join(s, li.l_suppkey == s.s_suppkey, "inner")


def _shares(spark, sf, plan) -> DataFrame:
    return analysis.run_plan(_lineitem_suppliers(spark, sf), plan)


def plan_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Plan-driven shares per supplier nation (+ a repeat plan)."""
    return _shares(spark, sf, PLAN_SHARES + PLAN_REPEAT)


def _rounded(df: DataFrame, names=("numbers", "se", "min", "max")) -> DataFrame:
    return df.withColumns({n: _round(n) for n in names})


def plan_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """Mean, se and interval of price per supplier nation."""
    return _rounded(_shares(spark, sf, PLAN_NUMERIC))


def auto_plan(spark: SparkSession, sf: str) -> DataFrame:
    """A plan made from the line-item schema (keys excluded), grouped by line status."""
    li = _t(spark, sf, "lineitem")
    plan = analysis.auto_plan(li, independent="l_linestatus",
                              exclude=["l_orderkey", "l_partkey", "l_suppkey"])
    return _rounded(analysis.run_plan(li, plan))


def labelled_results(spark: SparkSession, sf: str) -> DataFrame:
    """Result codes labelled (first match); p-values attached - none exist for
    direct reporting, so the supplied table is empty and every p-value is null."""
    res = _shares(spark, sf, PLAN_SHARES)
    lab = analysis.label_results(res, code_dictionary(spark))
    pv = spark.createDataFrame([], "`dependent.var` string, `p.value` double")
    return joins.attach_p_values(lab, pv, "dependent.var")


def multi_response(spark: SparkSession, sf: str) -> DataFrame:
    """Event-type options per user: frequency, percent of responses, percent
    of cases and the total row."""
    e = _t(spark, sf, "events")
    types = ["click", "error", "purchase", "signup", "view"]
    per_user = e.groupBy("user_id").pivot("event_type", types).agg(F.count(F.lit(1))).fillna(0, subset=types)
    return agg.multiple_response(per_user, types)


def _merge_input(spark, sf) -> DataFrame:
    return _shares(spark, sf, PLAN_SHARES)


def merge_table(spark: SparkSession, sf: str) -> DataFrame:
    """One row per nation, ``var.value`` columns x100,
    rounded half-even, nulls -> 0, lower-case headers."""
    wide = reshape.to_merge_table(_merge_input(spark, sf))
    value_cols = [c for c in wide.columns if c != "independent.var.value"]
    wide = fill_values(wide.withColumns({c: pct100(c) for c in value_cols}), 0.0, value_cols)
    return cols.lower_headers(wide)


def merge_confints(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers, min and max pivoted on a ``:::`` composite key."""
    res = _merge_input(spark, sf).drop("is_percent", "repeat.var", "repeat.var.value")
    res = res.withColumns({n: _round(n) for n in ["numbers", "min", "max"]})
    keyed = res.withColumn("_k", reshape.composite_key("dependent.var", "dependent.var.value", sep=":::"))
    keyed, keys = reshape.pivot_keys(keyed, "_k")
    return reshape.to_merge_table_confints(keyed.drop("_k"), keys, rows=("independent.var", "independent.var.value"))


def format_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Result text such as ``45% (40%-50%)``; both plans run in
    one scan, and the numeric results have their interval blanked, so they print
    without one."""
    res = blank_interval(_shares(spark, sf, PLAN_SHARES + PLAN_NUMERIC), where=~F.col("is_percent"))
    f = format_results(res, ["dependent.var", "independent.var"])
    return cols.select_cols(f, ["dependent.var", "dependent.var.value", "independent.var.value", "formatted"])


def results_subset(spark: SparkSession, sf: str) -> DataFrame:
    """Results of two variables whose share is above 0.3."""
    res = _shares(spark, sf, PLAN_SHARES).withColumn("keep", F.col("numbers") > 0.3)
    return analysis.results_subset(res, dependent_vars=["l_returnflag", "l_linenumber"], mask="keep").drop("keep")


# ------------------------------------------------------------------ columns and text

def drop_policy(spark: SparkSession, sf: str) -> DataFrame:
    """Range select, policy drop, V1 -> V2 renames."""
    c = _t(spark, sf, "customer")
    r = cols.select_range(c, "c_name", "c_acctbal", keep=["c_custkey", "c_mktsegment"])
    r = cols.apply_policy(r, CUSTOMER_POLICIES, "external")  # names absent from the table are ignored
    r = cols.drop_cols(r, ["c_nationkey"])                   # P6: one column
    return cols.rename_cols(r, CUSTOMER_V1_TO_V2)


def reorder(spark: SparkSession, sf: str) -> DataFrame:
    """Header fixes and column moves."""
    o = _t(spark, sf, "orders").withColumn("o_uuid", F.col("o_orderkey").cast("string"))
    o = cols.uuid_header(o)
    o = cols.reorder_columns(o, [("uuid", "first"), (["o_totalprice"], "last"),
                                 (["o_orderpriority"], "after", "uuid"), (["o_custkey"], "before", "o_orderstatus")])
    o = cols.prefix_headers(o, "@", ["o_orderpriority"])
    ids = ["uuid", "@o_orderpriority", "o_custkey"]
    # Two column groups of one frame bound side by side in a single select.
    return cols.select_cols(o, ids + [c for c in o.columns if c not in ids and c != "o_orderdate"])


SECRET_PATTERN = "password|secret"


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    """Text fixes over whole texts."""
    d = _t(spark, sf, "documents").filter(~matches("text", SECRET_PATTERN))
    out = d.select(
        "doc_id",
        normalise_cell(F.concat_ws(" ", "lang", "source")).alias("lang_source"),
        replace_first("source", "src", "src_").alias("source_code"),
        F.length(trim_ws("text")).cast("long").alias("text_len"),
        F.length(replace_all(replace_all("text", " ", " - "), "_", " ")).cast("long").alias("dashed_len"),
        F.upper("lang").alias("lang_upper"))
    string_cols = [f.name for f in out.schema.fields if isinstance(f.dataType, T.StringType)]
    return out.withColumns({c: F.lower(col(c)) for c in string_cols})  # X1: one function over many columns


def clean_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Grouped headers stripped, normalised, lower-cased, first of
    repeated headers kept."""
    e = _t(spark, sf, "events").select(
        F.col("event_id").alias("meta.event_id"), F.col("user_id").alias("meta.User ID"),
        F.col("event_type").alias("body.Event-Type"), F.col("value").alias("body.value"),
        F.col("props").alias("extra.value"))
    e = cols.strip_group_prefix(e)
    e = cols.keep_first_duplicate_headers(e)
    e = cols.normalise_headers(e)
    return cols.lower_headers(e)


def site_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Status columns as icon paths, a map path, one select."""
    s = _t(spark, sf, "supplier")
    bal = F.col("s_acctbal")
    status = s.select(
        "s_suppkey", "s_name", "s_nationkey",
        F.when(bal < 0, "non_existent").when(bal < 3000, "inadequate").when(bal < 6000, "adequate")
        .alias("balance_status"),
        F.when(F.col("s_nationkey") < 10, "adequate").when(F.col("s_nationkey") < 20, "inadequate")
        .alias("nation_status"))
    status_cols = ["balance_status", "nation_status"]
    filled = status.fillna("not_applicable", subset=status_cols)
    icons = lookup.map_values(filled, status_cols, STATUS_ICONS)
    icons = cols.prefix_headers(icons, "@", status_cols)
    maps = paste(survey.SITE_MAP_PREFIX, trim_ws("s_name"), "__", F.col("s_nationkey"), survey.SITE_MAP_SUFFIX)
    return icons.select("s_suppkey", "s_name", *[col("@" + c) for c in status_cols], maps.alias("@maps"))


CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])
ADMIN_SCHEMA = T.StructType([
    T.StructField("admin1Pcode", T.IntegerType()), T.StructField("admin1Name_en", T.StringType()),
    T.StructField("admin2Pcode", T.IntegerType()), T.StructField("admin2Name_en", T.StringType())])


def io_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """One run directory dated by argument, under the shared
    checkpoint folder, holding the customer table (parquet, as a run table) and an
    admin list (CSV with header, from nation x region); both are read back with
    declared schemas (the admin list through the UTF-8 admin-list reader) and joined."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/io_roundtrip/{_uuid.uuid4().hex}"
    run_dir = io.dated_path(base, "2026-01-01")
    io.write_tables({"responses": _t(spark, sf, "customer")}, run_dir)
    n, r = _t(spark, sf, "nation"), _t(spark, sf, "region")
    admin = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("r_regionkey").alias("admin1Pcode"), F.col("r_name").alias("admin1Name_en"),
        F.col("n_nationkey").alias("admin2Pcode"), F.col("n_name").alias("admin2Name_en"))
    io.write_table(admin, f"{run_dir}/admin_list", fmt="csv")
    resp = io.read_sheet(spark, run_dir, "responses", CUSTOMER_SCHEMA)
    adm = io.read_admin_list(spark, f"{run_dir}/admin_list", schema=ADMIN_SCHEMA)
    return resp.join(adm, resp.c_nationkey == adm.admin2Pcode, "left").select(
        "c_custkey", "c_name", "c_acctbal", F.col("admin2Name_en").alias("nation_name"),
        F.col("admin1Name_en").alias("region_name"))


QUERIES = {
    "rule_range": rule_range,
    "rule_cross_field": rule_cross_field,
    "rule_adequacy": rule_adequacy,
    "rule_prefix": rule_prefix,
    "dup_keys": dup_keys,
    "duration_check": duration_check,
    "outliers": outliers,
    "issue_log": issue_log,
    "lookup_first": lookup_first,
    "lookup_frame": lookup_frame,
    "dim_hierarchy": dim_hierarchy,
    "apply_log": apply_log,
    "override_code": override_code,
    "recode_derive": recode_derive,
    "append_new": append_new,
    "membership": membership,
    "site_codes": site_codes,
    "group_totals": group_totals,
    "weighted_mode": weighted_mode,
    "mode_first_seen": mode_first_seen,
    "indicator_join": indicator_join,
    "plan_shares": plan_shares,
    "plan_numeric": plan_numeric,
    "auto_plan": auto_plan,
    "labelled_results": labelled_results,
    "multi_response": multi_response,
    "merge_table": merge_table,
    "merge_confints": merge_confints,
    "format_numbers": format_numbers,
    "results_subset": results_subset,
    "drop_policy": drop_policy,
    "reorder": reorder,
    "clean_text": clean_text,
    "clean_headers": clean_headers,
    "site_merge": site_merge,
    "io_roundtrip": io_roundtrip,
}
