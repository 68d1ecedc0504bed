"""Runs over time, bound to the driver's tables: written order, masters kept by key, change
trails, codes over several runs.  Each query stands beside its DuckDB SQL."""

from __future__ import annotations

import uuid as _uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formsieve.operators import lookup
from formsieve.operators.corrections import apply_log, change_trail, undo
from formsieve.operators.sitecodes import assign_free_codes
from formsieve.plans import oracle
from formsieve.plans.catalog import _stand_in_batches, _stand_in_correction_log, _stand_in_sites, _t
from formsieve.session import checkpoint_dir
from formsieve.sources import io, master


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}/{_uuid.uuid4().hex}"


def _written_in_order(df: DataFrame, order: list[str], path: str, files: int = 8) -> str:
    """CSV part files whose names and rows follow ``order``; sizes differ, so tasks won't follow the names."""
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).drop(*[c for c in order if c.startswith("_")]) \
        .write.option("header", True).csv(path)
    return path


# ------------------------------------------------------------------ written order

def file_order(spark: SparkSession, sf: str) -> DataFrame:
    """A dictionary without stored order, in many files - per code the first
    label written, and the number of its row."""
    li = _t(spark, sf, "lineitem")
    entries = li.select(F.col("l_returnflag").alias("list_name"), F.col("l_partkey").alias("name"),
                        F.concat_ws("-", "l_orderkey", "l_suppkey", "l_linenumber").alias("label::english"),
                        F.col("l_orderkey").alias("_a"), F.col("l_linenumber").alias("_b"), F.col("l_partkey").alias("_c"), F.col("l_suppkey").alias("_d"))
    d = io.read_dictionary(spark, _written_in_order(entries, ["_a", "_b", "_c", "_d"], _folder(spark, "file_order")))
    parts = _t(spark, sf, "part").select("p_partkey")
    first = d.groupBy(F.col("name").cast("long").alias("p_partkey")).agg(F.min("ord").alias("first_row"))
    return lookup.lookup_first(parts, "p_partkey", d, "first_label").join(first, "p_partkey", "left")


FILE_ORDER = """
WITH d AS (SELECT l_partkey, concat_ws('-', l_orderkey, l_suppkey, l_linenumber) AS label,
                  row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ord FROM lineitem),
f AS (SELECT l_partkey, arg_min(label, ord) AS first_label, min(ord) AS first_row FROM d GROUP BY l_partkey)
SELECT p_partkey, first_label, first_row FROM part LEFT JOIN f ON p_partkey = l_partkey"""


def file_order_log(spark: SparkSession, sf: str) -> DataFrame:
    """A log without stored order, in many files - the last entry written wins."""
    li = _t(spark, sf, "lineitem")
    entries = li.select(F.col("l_orderkey").alias("uuid"), F.lit("o_orderpriority").alias("variable"),
                        F.concat_ws("-", "l_partkey", "l_suppkey", "l_linenumber").alias("new_value"), F.lit("checked").alias("fix"),
                        F.when(F.col("l_returnflag") == "R", "FALSE").otherwise("TRUE").alias("change"),
                        F.col("l_partkey").alias("_a"), F.col("l_orderkey").alias("_b"), F.col("l_linenumber").alias("_c"), F.col("l_suppkey").alias("_d"))
    log = io.read_correction_log(spark, _written_in_order(entries, ["_a", "_b", "_c", "_d"], _folder(spark, "file_order_log")))
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return apply_log(orders.withColumnRenamed("o_orderkey", "uuid"), log).withColumnRenamed("uuid", "o_orderkey")


FILE_ORDER_LOG = """
WITH l AS (SELECT l_orderkey, arg_max(concat_ws('-', l_partkey, l_suppkey, l_linenumber), ord) AS v FROM (
             SELECT *, row_number() OVER (ORDER BY l_partkey, l_orderkey, l_linenumber, l_suppkey) AS ord FROM lineitem)
           WHERE l_returnflag <> 'R' GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(v, o_orderpriority) AS o_orderpriority FROM orders LEFT JOIN l ON o_orderkey = l_orderkey"""


# ------------------------------------------------------------------ masters kept by key

def _master(spark: SparkSession, rows: DataFrame) -> str:
    """A new bucketed master table of ``rows``; returns its name."""
    name = f"master_{_uuid.uuid4().hex}"
    master.create_master(rows, name, "uuid", 8, _folder(spark, "master"))
    return name


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("uuid", F.col("o_orderkey").cast("string"))


def master_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches appended to a bucketed master, one after the other; the second
    lacks a column.  The master is never shuffled."""
    _, held, b1, b2 = _stand_in_batches(spark, sf)
    name = _master(spark, _keyed(held))
    master.append_new(_keyed(b1), name)
    return master.append_new(_keyed(b2).drop("kobo_version"), name)


MASTER_APPEND = """
WITH m AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
b1 AS (SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT o_orderkey FROM m)),
m1 AS (SELECT * FROM m UNION ALL SELECT * FROM b1),
b2 AS (SELECT * REPLACE (NULL::VARCHAR AS o_orderpriority) FROM orders
       WHERE o_orderpriority = '1-URGENT' AND o_orderkey NOT IN (SELECT o_orderkey FROM m1))
SELECT *, CAST(o_orderkey AS VARCHAR) AS uuid FROM (SELECT * FROM m1 UNION ALL SELECT * FROM b2)"""


def _order_log(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as corrections of their orders: a price, or a text that is no price."""
    li = _t(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").cast("string").alias("uuid"), F.lit("o_totalprice").alias("variable"),
                     F.when(F.col("l_linenumber") == 3, "unknown").otherwise(F.col("l_quantity").cast("long").cast("string")).alias("new_value"),
                     F.when(F.col("l_returnflag") == "N", "TRUE").otherwise("FALSE").alias("change"),
                     (F.col("l_partkey") * 100_000_000 + F.col("l_suppkey") * 1_000 + F.col("l_linenumber") * 100 + F.col("l_quantity").cast("long")).alias("ord"))


def master_corrected(spark: SparkSession, sf: str) -> DataFrame:
    """A log applied to a bucketed master and the result written as its next version,
    bucket by bucket; prices that don't parse leave the cell alone."""
    name = _master(spark, _keyed(_t(spark, sf, "orders")))
    fixed = master.corrected(name, _order_log(spark, sf))
    return master.rewrite(fixed, name, f"{name}_2", _folder(spark, "master")).drop("uuid")


MASTER_CORRECTED = """
WITH l AS (SELECT l_orderkey, arg_max(CASE WHEN l_linenumber = 3 THEN 'unknown' ELSE CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR) END,
                                      l_partkey * 100000000 + l_suppkey * 1000 + l_linenumber * 100 + CAST(trunc(l_quantity) AS BIGINT)) AS v
           FROM lineitem WHERE l_returnflag = 'N' GROUP BY l_orderkey)
SELECT orders.* REPLACE (coalesce(TRY_CAST(v AS DOUBLE), o_totalprice) AS o_totalprice) FROM orders LEFT JOIN l ON o_orderkey = l_orderkey"""


# ------------------------------------------------------------------ change trail

def _customers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return _t(spark, sf, "customer").withColumnRenamed("c_custkey", "uuid"), _stand_in_correction_log(spark, sf)


def log_trail(spark: SparkSession, sf: str) -> DataFrame:
    """What the log did to each cell - before, after, the entry, the outcome."""
    return change_trail(*_customers(spark, sf)).withColumnRenamed("uuid", "c_custkey")


def _trail_part(column: str, prefix: str, kind: str | None) -> str:
    """The trail's rows of one column; ``fx`` has the last entry per customer and column."""
    cell = f"CAST({column} AS VARCHAR)"
    value = f"v_{prefix}" if kind is None else f"CAST(TRY_CAST(v_{prefix} AS {kind}) AS VARCHAR)"
    bad = "false" if kind is None else f"v_{prefix} IS NOT NULL AND TRY_CAST(v_{prefix} AS {kind}) IS NULL"
    return (f"SELECT c_custkey, '{column}' AS variable, {cell} AS before, CASE WHEN {bad} THEN {cell} ELSE {value} END AS after, v_{prefix} AS entry, "
            f"CASE WHEN {bad} THEN 'value does not parse' WHEN {cell} IS NOT DISTINCT FROM {value} THEN 'value was already there' ELSE 'changed' END AS outcome "
            f"FROM j WHERE h_{prefix}")


LOG_TRAIL = (oracle.APPLY_LOG.split("SELECT c_custkey,")[0] +
             ", j AS (SELECT * FROM customer JOIN fx ON CAST(c_custkey AS VARCHAR) = fx.uuid)\n" +
             "\nUNION ALL ".join([_trail_part("c_name", "name", None), _trail_part("c_nationkey", "nat", "INTEGER"),
                                  _trail_part("c_acctbal", "bal", "DOUBLE"), _trail_part("c_mktsegment", "seg", None)]))


def log_undone(spark: SparkSession, sf: str) -> DataFrame:
    """The log applied and taken back by its trail: the input."""
    data, log = _customers(spark, sf)
    return undo(apply_log(data, log), change_trail(data, log)).withColumnRenamed("uuid", "c_custkey")


LOG_UNDONE = "SELECT * FROM customer"


# ------------------------------------------------------------------ codes over runs

FIRST, LAST, RUNS = 1185, 1284, 3


def site_codes_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs of new sites; each takes the lowest numbers that its district has free, beside codes
    held from before, and a district that runs out leaves sites without a code."""
    held = _t(spark, sf, "nation").select(F.concat(F.lit("BUI_"), (FIRST + 3 * F.col("n_nationkey")).cast("string")).alias("site_code"))
    sites = _stand_in_sites(spark, sf).filter("site_code IS NULL")
    out = None
    for run in range(RUNS):
        batch = sites.filter(F.col("c_custkey") % RUNS == run)
        coded, _ = assign_free_codes(batch, held, "site_code", "site_name", "district_code", "c_custkey", FIRST, LAST)
        coded = _saved(coded)
        held = held.unionByName(coded.select("site_code").filter("site_code IS NOT NULL"))
        out = coded if out is None else out.unionByName(coded)
    return out.select("c_custkey", "site_code")


def _saved(df: DataFrame) -> DataFrame:
    """A run's result as a table: the next run reads it instead of repeating the run."""
    path = _folder(df.sparkSession, "run")
    io.write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SITE_CODES_RUNS = f"""
WITH s AS (SELECT c_custkey, nullif(CAST(c_nationkey AS VARCHAR), '3') AS site_name,
                  coalesce(nullif(substring(c_mktsegment, 1, 3), 'HOU'), 'NA') AS d FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
k AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY c_custkey % {RUNS}, site_name NULLS FIRST, c_custkey) AS k FROM s),
u AS (SELECT 'BUI' AS d, {FIRST} + 3 * n_nationkey AS n FROM nation),
f AS (SELECT d, n, row_number() OVER (PARTITION BY d ORDER BY n) AS k
      FROM (SELECT d, unnest(generate_series({FIRST}, {LAST})) AS n FROM (SELECT DISTINCT d FROM s)) g
      WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.d = g.d AND u.n = g.n))
SELECT c_custkey, k.d || '_' || CAST(f.n AS VARCHAR) AS site_code FROM k LEFT JOIN f USING (d, k)"""


QUERIES = {f.__name__: f for f in (file_order, file_order_log, master_append, master_corrected, log_trail, log_undone, site_codes_runs)}
ORACLE_SQL = {"file_order": FILE_ORDER, "file_order_log": FILE_ORDER_LOG, "master_append": MASTER_APPEND, "master_corrected": MASTER_CORRECTED,
              "log_trail": LOG_TRAIL, "log_undone": LOG_UNDONE, "site_codes_runs": SITE_CODES_RUNS}
