"""Readers and writers.

Workbooks are re-aimed as partitioned tables: one table per sheet, one directory per
run, a ``run_date=YYYY-MM-DD`` partition instead of a date in the file name.  Readers
take declared schemas so no job is spent on inference and the scan prunes columns.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formsieve.sources import order

# Technical column names the form server writes, mapped to the names
# the scripts use.
SERVER_RENAMES = {"_index": "index", "_uuid": "uuid"}

# The nine text columns of an issue log, in order.
ISSUE_LOG_COLUMNS = ["uuid", "agency", "area", "variable", "issue", "old_value",
                     "new_value", "fix", "checked_by"]
ISSUE_LOG_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ISSUE_LOG_COLUMNS])

# Columns of a correction log.
CORRECTION_LOG_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                                      ["uuid", "variable", "new_value", "fix", "change"]])

DICTIONARY_SCHEMA = T.StructType([
    T.StructField("ord", T.LongType()),
    T.StructField("list_name", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("label_english", T.StringType()),
    T.StructField("label_arabic", T.StringType()),
])

# Columns of an analysis plan.
PLAN_COLUMNS = ["Indicator", "research.question", "sub.research.question", "hypothesis",
                "repeat.for.variable", "independent.variable", "independent.variable.type",
                "dependent.variable", "dependent.variable.type", "hypothesis.type"]


def _reader(spark: SparkSession, fmt: str, schema: T.StructType | None, options: Mapping | None):
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r


def read_responses(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   fmt: str = "parquet", options: Mapping | None = None) -> DataFrame:
    """A response table with a declared schema; server column names normalised."""
    df = _reader(spark, fmt, schema, options).load(path)
    present = {k: v for k, v in SERVER_RENAMES.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def read_sheet(spark: SparkSession, run_dir: str, sheet: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """One named table of a multi-table run directory."""
    return _reader(spark, fmt, schema, None).load(f"{run_dir.rstrip('/')}/{sheet}")


def normalise_dictionary_header(name: str) -> str:
    """``label::english`` and ``label..english`` both become ``label_english``."""
    return re.sub(r"[^A-Za-z0-9_]+", "_", name.strip()).strip("_")


_ORDER = (*order.SPLIT, order.ROW)


def _ordered(spark: SparkSession, path: str | Sequence[str], fmt: str) -> DataFrame:
    return order.load_in_order(spark, path, fmt, options={"encoding": "UTF-8"} if fmt == "csv" else None)


def _with_ord(df: DataFrame) -> DataFrame:
    if "ord" not in df.columns:
        return order.numbered(df)
    # a text file gives text: row 10 comes after row 9
    return df.drop(*_ORDER).withColumn("ord", F.col("ord").try_cast("long"))


def read_dictionary(spark: SparkSession, path: str | Sequence[str], fmt: str = "csv") -> DataFrame:
    """S3: the code dictionary with an explicit ``ord`` column.

    Files that carry ``ord`` keep it.  Otherwise ``ord`` is the row number in the written
    order, over all files and splits of ``path`` (see :mod:`formsieve.sources.order`).
    Blank rows are dropped, as they can never match.
    """
    df = _ordered(spark, path, fmt)
    df = df.toDF(*[c if c in _ORDER else normalise_dictionary_header(c) or f"blank_{i}" for i, c in enumerate(df.columns)])
    df = _with_ord(df)
    keep = [c for c in ["ord", "list_name", "name", "label_english", "label_arabic"] if c in df.columns]
    df = df.select(*keep)
    blank = lambda c: F.coalesce(F.length(F.regexp_replace(F.col(c), r"\s", "")), F.lit(0)) == 0
    return df.filter(~(blank("list_name") & blank("name")))


def read_admin_list(spark: SparkSession, path: str, fmt: str = "csv",
                    schema: T.StructType | None = None) -> DataFrame:
    """Administrative list (three levels of code and name), UTF-8."""
    return _reader(spark, fmt, schema, {"encoding": "UTF-8"} if fmt == "csv" else None).load(path)


def read_correction_log(spark: SparkSession, path: str | Sequence[str], fmt: str = "csv") -> DataFrame:
    """S2 for an edited log: the ``cleaning_log`` table with an ``ord`` column.

    "Last entry wins" needs the log's row order: a stored ``ord`` is kept, otherwise it
    is the row number in the written order, over all files and splits of ``path``."""
    return _with_ord(_ordered(spark, path, fmt))


def read_questionnaire(spark: SparkSession, questions_path: str, choices_path: str,
                       fmt: str = "csv") -> tuple[dict[str, str], DataFrame, DataFrame]:
    """The questionnaire bound to the data - question types (metadata, read on the
    driver; one row per question), the choices dictionary, and question -> choice list.

    Question types look like ``select_one list_name``; the list name is split off."""
    q = _reader(spark, fmt, None, {"encoding": "UTF-8"} if fmt == "csv" else None).load(questions_path)
    q = q.select(F.lower(F.trim(F.col("name"))).alias("name"), F.trim(F.col("type")).alias("type"))
    types = {r["name"]: r["type"] for r in q.filter(F.col("name").isNotNull()).collect()}
    lists = q.select("name", F.try_element_at(F.split("type", r"\s+"), F.lit(2)).alias("list_name")) \
        .filter(F.col("list_name").isNotNull())
    return types, read_dictionary(spark, choices_path, fmt), lists


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """Analysis plan, all text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in PLAN_COLUMNS])
    return _reader(spark, "csv", schema, {"encoding": "UTF-8"}).load(path)


def template_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table that fixes column order and types for a union."""
    return spark.createDataFrame([], schema)


def read_site_master(spark: SparkSession, path: str, name_col: str = "site.name",
                     code_col: str = "new.code", fmt: str = "parquet") -> DataFrame:
    """Site-code master list as (site_name, site_code), names trimmed of all whitespace."""
    from formsieve.functions.text import trim_ws
    df = _reader(spark, fmt, None, None).load(path)
    return df.select(trim_ws(F.col(f"`{name_col}`")).alias("site_name"),
                     F.col(f"`{code_col}`").alias("site_code"))


def dated_path(base: str, run_date: str) -> str:
    """``run_date`` partition directory; the date is an argument, never the clock."""
    return f"{base.rstrip('/')}/run_date={run_date}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """One table.  CSV is written with a header and without row names."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_tables(tables: Mapping[str, DataFrame], run_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """Several named tables of one run; one sub-directory per table."""
    out = {}
    for name, df in tables.items():
        safe = re.sub(r"[^A-Za-z0-9_]+", "_", name).strip("_").lower()
        path = f"{run_dir.rstrip('/')}/{safe}"
        write_table(df, path, fmt=fmt)
        out[name] = path
    return out
