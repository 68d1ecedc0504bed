"""Tables of many shapes, bound to the driver's tables: unions over versions, large dictionaries,
wide tables of many keys, inspections, and the readers and joins that no other query
reaches.  Each query stands beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formsieve.operators import aggregate, columns
from formsieve.operators import inspection as inspect
from formsieve.operators import joins, lookup, reshape, versions, wide
from formsieve.plans import analysis, catalog
from formsieve.plans.catalog import _t
from formsieve.plans.catalog_runs import _folder
from formsieve.plans.oracle import DICT_FIRST, LS, Z, _dict_values
from formsieve.sources import io


# ------------------------------------------------------------------ unions over versions

def _stand_in_versions(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Orders as three versions of a form: as they are; keys as text, prices as text that isn't always a
    price, a new column; keys as doubles that aren't always whole, days as text that isn't always a day."""
    o = _t(spark, sf, "orders")
    v1 = o.filter("o_orderkey % 3 = 0").select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus")
    v2 = o.filter("o_orderkey % 3 = 1").select(
        "o_orderkey", F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderpriority").alias("priority"))
    v3 = o.filter("o_orderkey % 3 = 2").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "O", F.col("o_custkey") + 0.5).otherwise(F.col("o_custkey").cast("double")).alias("o_custkey"),
        F.col("o_totalprice"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("date").cast("string")).otherwise("soon").alias("day"))
    return [v1, v2, v3]


#: The template: whole customer numbers; every other column gets its versions' common type.
WHOLE_KEYS = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType())])


def union_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Three versions of a form on their common types; a cell that doesn't fit is null."""
    out = versions.union_versions(_stand_in_versions(spark, sf), WHOLE_KEYS, "o_orderkey", on_text="typed")[0]
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


_V2_PRICE = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END"
UNION_VERSIONS = f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 AND o_orderstatus = 'O' THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 3 = 1 THEN {_V2_PRICE} ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 3 < 2 OR o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS priority
FROM orders"""


def union_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """The cells of the three versions that their column's type can't hold."""
    return versions.union_versions(_stand_in_versions(spark, sf), WHOLE_KEYS, "o_orderkey", on_text="typed")[1]


UNION_REJECTS = """
SELECT 2 AS part, CAST(o_orderkey AS VARCHAR) AS key, 'o_totalprice' AS variable, 'n/a' AS value, 'double' AS wanted
FROM orders WHERE o_orderkey % 3 = 1 AND o_orderstatus = 'P'
UNION ALL SELECT 3, CAST(o_orderkey AS VARCHAR), 'o_custkey', CAST(o_custkey + 0.5::DOUBLE AS VARCHAR), 'bigint'
FROM orders WHERE o_orderkey % 3 = 2 AND o_orderstatus = 'O'
UNION ALL SELECT 3, CAST(o_orderkey AS VARCHAR), 'day', 'soon', 'date' FROM orders WHERE o_orderkey % 3 = 2 AND o_orderstatus <> 'F'"""


def union_strict(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with the same columns, in another order, under one another."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return reshape.union_strict([li.filter("l_returnflag = 'A'"), li.filter("l_returnflag = 'R'").select("l_returnflag", "l_orderkey", "l_linenumber")])


UNION_STRICT = "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'R')"


# ------------------------------------------------------------------ dictionaries beyond the literal bound

#: Entries that may become literal maps here; the dictionary has one per part and supplier.
LITERALS = 1_500


def lookup_occurring(spark: SparkSession, sf: str) -> DataFrame:
    """A frame labelled from a dictionary of more entries than may be literals: the codes
    that occur are found first, the frame is neither unpivoted nor shuffled."""
    p, s = _t(spark, sf, "part"), _t(spark, sf, "supplier")
    d = p.select(F.col("p_partkey").cast("string").alias("name"), F.col("p_name").alias("label_english"), F.col("p_partkey").alias("ord")) \
        .unionByName(s.select(F.col("s_suppkey").cast("string").alias("name"), F.col("s_name").alias("label_english"), (-1 - F.col("s_suppkey")).alias("ord")))
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return lookup.label_columns(li, ["l_suppkey", "l_linenumber", "l_quantity"], d, max_entries=LITERALS)


LOOKUP_OCCURRING = """
WITH d AS (SELECT CAST(p_partkey AS VARCHAR) AS name, p_name AS label, p_partkey AS ord FROM part
           UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, -1 - s_suppkey FROM supplier),
f AS (SELECT name, arg_min(label, ord) AS label FROM d WHERE name IS NOT NULL GROUP BY name)
SELECT l_orderkey, l_partkey, a.label AS l_suppkey, b.label AS l_linenumber, c.label AS l_quantity
FROM lineitem LEFT JOIN f a ON CAST(l_suppkey AS VARCHAR) = a.name LEFT JOIN f b ON CAST(l_linenumber AS VARCHAR) = b.name
              LEFT JOIN f c ON CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) = c.name AND l_quantity = floor(l_quantity)"""


# ------------------------------------------------------------------ wide tables of many keys

def _quantities(spark: SparkSession, sf: str) -> DataFrame:
    """Results per return flag and part: as many keys as there are parts."""
    return _t(spark, sf, "lineitem").groupBy("l_returnflag", F.concat(F.lit("part."), F.col("l_partkey").cast("string")).alias("var")) \
        .agg(F.sum("l_quantity").alias("numbers"))


def wide_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """A wide table of one column per part, written as column groups and read back."""
    path = _folder(spark, "wide_blocks")
    wide.write_blocks(_quantities(spark, sf), ["l_returnflag"], "var", "numbers", path, block_columns=1_000)
    return wide.read_long(spark, path, ["l_returnflag"], "var", "numbers")


WIDE_BLOCKS = "SELECT l_returnflag, 'part.' || CAST(l_partkey AS VARCHAR) AS var, sum(l_quantity) AS numbers FROM lineitem GROUP BY ALL"


def wide_map(spark: SparkSession, sf: str) -> DataFrame:
    """The same cells as one map per return flag: number of keys, and three of its entries."""
    m = wide.spread_map(_quantities(spark, sf), ["l_returnflag"], "var", "numbers")
    return m.select("l_returnflag", F.size("cells").alias("n_keys"),
                    *[F.try_element_at("cells", F.lit(f"part.{k}")).alias(f"part_{k}") for k in (1, 2, 100)])


WIDE_MAP = """
SELECT l_returnflag, CAST(count(DISTINCT l_partkey) AS INTEGER) AS n_keys, sum(l_quantity) FILTER (WHERE l_partkey = 1) AS part_1,
       sum(l_quantity) FILTER (WHERE l_partkey = 2) AS part_2, sum(l_quantity) FILTER (WHERE l_partkey = 100) AS part_100
FROM lineitem GROUP BY l_returnflag"""


# ------------------------------------------------------------------ inspection

def _stand_in_contacts(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with a free-text answer to "other", a phone number and an address under names that don't tell."""
    c, k = _t(spark, sf, "customer"), F.col("c_custkey")
    return c.select(
        "c_custkey", "c_acctbal", "c_mktsegment", F.col("c_name").alias("contact_name"),
        F.when(F.col("c_nationkey") < 9, F.concat(F.lit(" need "), F.col("c_nationkey").cast("string"))).alias("need.other"),
        F.concat(F.lit("77"), (k + 1_000_000).cast("string")).alias("q7"),
        F.when(k % 4 > 0, F.concat(F.lit("c"), k.cast("string"), F.lit("@mail.example"))).otherwise("none").alias("remark"),
        F.concat((k % 5).cast("string"), F.lit("1234567")).alias("batch_code"))


def inspection(spark: SparkSession, sf: str) -> DataFrame:
    """Free-text answers with their instances, and sensitive columns, from one aggregate."""
    return inspect.findings(inspect.profile(_stand_in_contacts(spark, sf)))


_OTHER = "'''other'' response. may need recoding.'"
_SENSITIVE = "'Potentially sensitive information.'"
INSPECTION = f"""
SELECT 'need.other' AS variable, 'need ' || CAST(c_nationkey AS VARCHAR) AS value, count(*) AS n, {_OTHER} AS issue_type
FROM customer WHERE c_nationkey < 9 GROUP BY c_nationkey
UNION ALL SELECT 'contact_name', 'name', count(c_name), {_SENSITIVE} FROM customer
UNION ALL SELECT 'q7', 'phone', count(*), {_SENSITIVE} FROM customer
UNION ALL SELECT 'remark', 'email', count(*), {_SENSITIVE} FROM customer"""


def inspection_kept(spark: SparkSession, sf: str) -> DataFrame:
    """The findings without the sensitive columns, as a workflow drops a kind."""
    return inspect.without_kinds(inspection(spark, sf), ["Potentially sensitive information."])


INSPECTION_KEPT = f"SELECT * FROM ({INSPECTION}) WHERE issue_type <> {_SENSITIVE}"


# ------------------------------------------------------------------ readers and joins of single rows

def read_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Responses as the form server writes them, read with a declared schema and its names normalised."""
    path = _folder(spark, "responses")
    io.write_table(_t(spark, sf, "customer").select(F.col("c_custkey").alias("_index"), F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("_uuid"),
                                                    "c_name", "c_acctbal"), path, fmt="csv")
    schema = T.StructType([T.StructField("_index", T.LongType()), T.StructField("_uuid", T.StringType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_acctbal", T.DoubleType())])
    return io.read_responses(spark, path, schema, fmt="csv")


READ_RESPONSES = "SELECT c_custkey AS index, 'u' || CAST(c_custkey AS VARCHAR) AS uuid, c_name, c_acctbal FROM customer"


def plan_from_files(spark: SparkSession, sf: str) -> DataFrame:
    """A plan and a questionnaire read from files; the plan run, its answers labelled from the
    questionnaire's choice lists."""
    path = _folder(spark, "plan")
    as_text = [[str(r[c]) if r.get(c) is not None else None for c in io.PLAN_COLUMNS] for r in catalog.PLAN_SHARES]
    io.write_table(spark.createDataFrame(as_text, T.StructType([T.StructField(c, T.StringType()) for c in io.PLAN_COLUMNS])).coalesce(1), f"{path}/plan", fmt="csv")
    questions = [("select_one flag", "L_RETURNFLAG "), ("select_one linestatus", "l_linestatus"), ("integer", "l_linenumber"), ("note", None)]
    io.write_table(spark.createDataFrame(questions, "type string, name string").coalesce(1), f"{path}/questions", fmt="csv")
    io.write_table(catalog.code_dictionary(spark).orderBy("ord").select("list_name", "name", F.col("label_english").alias("label::english")).coalesce(1),
                   f"{path}/choices", fmt="csv")
    types, choices, lists = io.read_questionnaire(spark, f"{path}/questions", f"{path}/choices")
    kinds = analysis.column_types(_t(spark, sf, "lineitem"), types)
    plan = [r for r in analysis.plan_rows(io.read_plan(spark, f"{path}/plan")) if r.dependent in kinds]
    results = analysis.run_plan(catalog._lineitem_suppliers(spark, sf), plan)
    return analysis.label_results(results, choices, lists)


def _plan_from_files_sql() -> str:
    parts = []
    for dep, scope in (("l_returnflag", "flag"), ("l_linestatus", "linestatus"), ("l_linenumber", None)):
        label = f"(SELECT arg_min(label, ord) FROM d WHERE list_name = '{scope}' AND name = c.v)" if scope else "NULL::VARCHAR"
        se = "sqrt(p * (1 - p) / t)"
        parts.append(f"""SELECT '{dep}' AS "dependent.var", v AS "dependent.var.value", 's_nationkey' AS "independent.var", g AS "independent.var.value",
       p AS numbers, {se} AS se, greatest(0.0::DOUBLE, p - {Z} * {se}) AS min, least(1.0::DOUBLE, p + {Z} * {se}) AS max, NULL::VARCHAR AS "repeat.var",
       NULL::VARCHAR AS "repeat.var.value", true AS is_percent, {label} AS "dependent.var.value.label"
FROM (SELECT g, v, t, n / t AS p FROM (SELECT CAST(s_nationkey AS VARCHAR) AS g, CAST({dep} AS VARCHAR) AS v, count(*) AS n,
             sum(count(*)) OVER (PARTITION BY s_nationkey) AS t FROM ls WHERE {dep} IS NOT NULL AND s_nationkey IS NOT NULL GROUP BY s_nationkey, {dep})) c""")
    return f"WITH ls AS ({LS}), {_dict_values()}\n" + "\nUNION ALL ".join(parts)


def site_master(spark: SparkSession, sf: str) -> DataFrame:
    """A site-code master under its own headers, names trimmed."""
    path = _folder(spark, "site_master")
    io.write_table(_t(spark, sf, "supplier").select(F.concat(F.lit("\t "), F.col("s_name"), F.lit("\n")).alias("site.name"),
                                                    F.concat(F.lit("S_"), F.col("s_suppkey").cast("string")).alias("new.code")), path)
    return io.read_site_master(spark, path)


SITE_MASTER = "SELECT s_name AS site_name, 'S_' || CAST(s_suppkey AS VARCHAR) AS site_code FROM supplier"


def attach_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """Status and day of a customer's first order beside every customer."""
    o = _t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus", "o_totalprice")
    return joins.attach_by_key(_t(spark, sf, "customer").select("c_custkey", "c_name"), o, "c_custkey", ["o_orderstatus", "o_totalprice"], "o_orderkey")


ATTACH_BY_KEY = """
SELECT c_custkey, c_name, s AS o_orderstatus, p AS o_totalprice FROM customer LEFT JOIN (
  SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS s, arg_min(o_totalprice, o_orderkey) AS p FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey"""


def row_by_index(spark: SparkSession, sf: str) -> DataFrame:
    """Rows picked by their place in an order: every hundredth part by name."""
    ranked = joins.with_row_id(_t(spark, sf, "part").select("p_partkey", "p_name"), ["p_name", "p_partkey"])
    index = ranked.select(F.col("row_id").alias("index")).filter("index % 100 = 1")
    return index.join(ranked, index["index"] == ranked["row_id"]).select("index", "p_partkey", "p_name")


ROW_BY_INDEX = """
SELECT row_id AS index, p_partkey, p_name FROM (SELECT *, row_number() OVER (ORDER BY p_name NULLS FIRST, p_partkey) AS row_id FROM part) WHERE row_id % 100 = 1"""


def rows_in_set(spark: SparkSession, sf: str) -> DataFrame:
    """The suppliers of nations that a customer with a debt lives in."""
    debtors = _t(spark, sf, "customer").filter("c_acctbal < -500").select("c_nationkey")
    return joins.rows_in(_t(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), debtors, "s_nationkey", "c_nationkey")


ROWS_IN_SET = "SELECT s_suppkey, s_nationkey FROM supplier WHERE s_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal < -500)"


def collapsed_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Results that their labels make indistinguishable: two priorities called alike, per nation."""
    res = analysis.run_plan(catalog._stand_in_lineitem_orders(spark, sf), [
        {"dependent.variable": "o_orderpriority", "dependent.variable.type": "categorical", "independent.variable": "l_linestatus",
         "independent.variable.type": "categorical", "repeat.for.variable": None, "hypothesis.type": "direct_reporting", "Indicator": None}])
    alike = catalog.code_dictionary(spark).withColumn("label_english", F.when(F.col("name").isin("1-URGENT", "2-HIGH"), "Soon").otherwise(F.col("label_english")))
    return analysis.labelled_with_report(res, alike)[1]


COLLAPSED_LABELS = """
SELECT 'o_orderpriority' AS "dependent.var", 'l_linestatus' AS "independent.var", l_linestatus AS "independent.var.value", NULL::VARCHAR AS "repeat.var",
       NULL::VARCHAR AS "repeat.var.value", 'Soon' AS "dependent.var.value.label", count(DISTINCT o_orderpriority) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND l_linestatus IS NOT NULL
GROUP BY l_linestatus HAVING count(DISTINCT o_orderpriority) > 1"""


def multi_response_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """Multiple response by the question's prefix, per segment of the customer."""
    types = ["click", "error", "purchase", "signup", "view"]
    e, c = _t(spark, sf, "events"), _t(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    flags = e.groupBy("user_id").pivot("event_type", types).agg(F.count(F.lit(1))).fillna(0, subset=types).withColumnsRenamed({t: f"did.{t}" for t in types})
    return aggregate.multiple_response_by_prefix(flags.join(c, flags["user_id"] == c["c_custkey"]).drop("user_id", "c_custkey"), "did", "c_mktsegment")


_OPTIONS = ["click", "error", "purchase", "signup", "view"]
MULTI_RESPONSE_PREFIX = f"""
WITH u AS (SELECT user_id, {', '.join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in _OPTIONS)} FROM events GROUP BY user_id),
a AS (SELECT c_mktsegment, {', '.join(f"count(*) FILTER (WHERE {t} <> 0) AS {t}" for t in _OPTIONS)}, count(*) FILTER (WHERE {' + '.join(_OPTIONS)} <> 0) AS cases
      FROM u JOIN customer ON user_id = c_custkey GROUP BY c_mktsegment),
b AS (SELECT *, {' + '.join(_OPTIONS)} AS total FROM a),
s AS ({' UNION ALL '.join(f"SELECT c_mktsegment, '{t}' AS question, {t} AS freq, total, cases FROM b" for t in _OPTIONS)}
      UNION ALL SELECT c_mktsegment, 'Total', total, total, cases FROM b)
SELECT c_mktsegment, question, CAST(freq AS DOUBLE) AS freq, CAST(freq AS DOUBLE) / total * 100 AS percent, CAST(freq AS DOUBLE) / cases * 100 AS percentofcases FROM s"""


def label_by_position(spark: SparkSession, sf: str) -> DataFrame:
    """The columns at positions 2 to 4 labelled, the others left."""
    o = catalog._stand_in_lineitem_orders(spark, sf).select("l_orderkey", "l_returnflag", "l_linestatus", "o_orderpriority", "o_orderstatus", "l_linenumber")
    return lookup.label_columns(o, columns.column_slice(o, 2, 4), catalog.code_dictionary(spark))


LABEL_BY_POSITION = f"""
WITH {_dict_values()}, {DICT_FIRST}
SELECT l_orderkey, a.label AS l_returnflag, b.label AS l_linestatus, c.label AS o_orderpriority, o_orderstatus, l_linenumber
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN f a ON l_returnflag = a.name LEFT JOIN f b ON l_linestatus = b.name
              LEFT JOIN f c ON o_orderpriority = c.name"""


QUERIES = {f.__name__: f for f in (
    multi_response_prefix, label_by_position, union_versions, union_rejects, union_strict, lookup_occurring, wide_blocks, wide_map, inspection, inspection_kept, read_responses, plan_from_files,
    site_master, attach_by_key, row_by_index, rows_in_set, collapsed_labels)}
ORACLE_SQL = {
    "multi_response_prefix": MULTI_RESPONSE_PREFIX, "label_by_position": LABEL_BY_POSITION, "union_versions": UNION_VERSIONS, "union_rejects": UNION_REJECTS, "union_strict": UNION_STRICT, "lookup_occurring": LOOKUP_OCCURRING,
    "wide_blocks": WIDE_BLOCKS, "wide_map": WIDE_MAP, "inspection": INSPECTION, "inspection_kept": INSPECTION_KEPT, "read_responses": READ_RESPONSES,
    "plan_from_files": _plan_from_files_sql(), "site_master": SITE_MASTER, "attach_by_key": ATTACH_BY_KEY, "row_by_index": ROW_BY_INDEX,
    "rows_in_set": ROWS_IN_SET, "collapsed_labels": COLLAPSED_LABELS}
