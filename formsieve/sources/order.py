"""The written order of rows, over any number of files and splits.

"First match" and "last entry wins" mean the order in which rows were written.  Spark
packs splits into tasks by size, so ``monotonically_increasing_id`` alone follows the
packing, not the files.  But within one split rows come in file order, and every row
knows its file and its split's first byte (``_metadata``).  So

* ``(source, file, block, position)`` is a sort key of the written order that needs no
  job and no shuffle: first matches and last entries compare it as a struct;
* one count per split (a row per split, whatever the number of rows) turns it into row
  numbers from 1: the rows before the split plus the position inside it.

Files are ordered by path, which is the order in which a Spark writer numbers its part
files, or by modification time, for folders that batches are added to.  Several paths are
read in the order given.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns that carry the order from the scan to the numbering.
SOURCE, STAMP, FILE, BLOCK, ROW = "_ord_source", "_ord_time", "_ord_file", "_ord_block", "_ord_row"
SPLIT = [SOURCE, STAMP, FILE, BLOCK]


def load_in_order(spark: SparkSession, paths: str | Sequence[str], fmt: str = "csv", schema: T.StructType | None = None,
                  options: Mapping | None = None, by: str = "name") -> DataFrame:
    """The files of ``paths`` with the order columns of every row.

    ``by="name"``: files in path order; ``by="time"``: oldest modification first, equal
    times in path order."""
    if by not in ("name", "time"):
        raise ValueError(f"files are ordered by 'name' or 'time', not {by!r}")
    parts = []
    for i, path in enumerate([paths] if isinstance(paths, str) else paths):
        r = spark.read.format(fmt)
        r = r.schema(schema) if schema is not None else r
        r = r.option("header", True) if fmt == "csv" else r
        df = reduce(lambda a, kv: a.option(*kv), (options or {}).items(), r).load(path)
        m = F.col("_metadata")
        parts.append(df.select(
            "*", F.lit(i).alias(SOURCE),
            (m["file_modification_time"] if by == "time" else F.lit(None).cast("timestamp")).alias(STAMP),
            m["file_path"].alias(FILE), m["file_block_start"].alias(BLOCK), F.monotonically_increasing_id().alias(ROW)))
    if not parts:
        raise ValueError("no path to read")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def order_key() -> Column:
    """A struct that compares like the written order; null-free, so it serves ``min_by`` and ``max_by``."""
    return F.struct(*[F.col(c) for c in (*SPLIT, ROW)])


def with_order_key(df: DataFrame, out_col: str = "ord") -> DataFrame:
    """The written order as a sortable struct column: no job, no shuffle, any size."""
    return df.withColumn(out_col, order_key()).drop(*SPLIT, ROW)


def numbered(df: DataFrame, out_col: str = "ord") -> DataFrame:
    """The written order as row numbers from 1.

    One aggregate counts the rows of each split; the running total over those counts (a
    row per split) is joined back to the rows.  The join is the planner's choice by size."""
    splits = df.groupBy(*SPLIT).agg(F.count(F.lit(1)).alias("_n"), F.min(ROW).alias("_first"))
    before = Window.orderBy(*[F.col(c).asc_nulls_first() for c in SPLIT]).rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))) \
        .select(SOURCE, FILE, BLOCK, (F.col("_before") + 1 - F.col("_first")).alias("_shift"))
    return df.join(splits, [SOURCE, FILE, BLOCK]) \
        .withColumn(out_col, F.col(ROW) + F.col("_shift")).drop(*SPLIT, ROW, "_shift")


def read_in_order(spark: SparkSession, paths: str | Sequence[str], fmt: str = "csv", schema: T.StructType | None = None,
                  options: Mapping | None = None, by: str = "name", out_col: str = "ord", numbers: bool = True) -> DataFrame:
    """Rows with their place in the written order: numbers from 1, or the struct key."""
    df = load_in_order(spark, paths, fmt, schema, options, by)
    return numbered(df, out_col) if numbers else with_order_key(df, out_col)
