"""Wide tables of any number of keys.

A table of 50,000 columns is no table that a reader opens.  Beyond a few thousand keys the same
cells are kept as

* a map column: one row per group, ``key -> value`` (:func:`spread_map`); or
* column groups (:func:`write_blocks`): keys are numbered in order and dealt into blocks of so many columns.  A row is a group's
  cells in one block, by their place there; blocks are partitions of one Parquet table, and a key table tells
  block and place of each key.  A reader of some keys opens the blocks that hold them, and a block
  becomes a wide table under its keys' names when it is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formsieve.functions.nulls import col
from formsieve.operators.sitecodes import global_rank
from formsieve.session import materialize

BLOCK_COLUMNS = 2_000


def _one_value(c) -> Column:
    """A cell's value; two results for one cell are an error, not a choice."""
    return F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two results for one cell of a wide table"))).otherwise(F.first(col(c)))


def spread_map(df: DataFrame, index: Sequence[str], key: str, value: str, out_col: str = "cells") -> DataFrame:
    """R2: one row per group with a map ``key -> value``; null keys are left out.

    Cells are made unique first, where they are spread over tasks; a group then holds its distinct keys."""
    cells = df.filter(col(key).isNotNull()).groupBy(*[col(i) for i in index], col(key).cast("string").alias("_key")).agg(_one_value(value).alias("_value"))
    return cells.groupBy(*[col(i) for i in index]).agg(F.map_from_entries(F.collect_list(F.struct("_key", "_value"))).alias(out_col))


def numbered_keys(df: DataFrame, key: str, block_columns: int = BLOCK_COLUMNS) -> DataFrame:
    """(key, block, place): the distinct keys in order, numbered without one task seeing all."""
    ranked = global_rank(df.select(col(key).cast("string").alias("key")).filter("key IS NOT NULL").distinct(), ["key"], "rn")
    n = F.col("rn") - 1
    return ranked.select("key", F.expr(f"(rn - 1) div {block_columns}").cast("int").alias("block"), (n % block_columns).cast("int").alias("place"))


def write_blocks(df: DataFrame, index: Sequence[str], key: str, value: str, path: str, block_columns: int = BLOCK_COLUMNS) -> None:
    """Writes the wide table of long results as column groups under ``path``, in one job for all blocks."""
    keys = materialize(numbered_keys(df, key, block_columns))
    keys.write.mode("errorifexists").parquet(f"{path}/keys")
    by = [col(i) for i in index]
    df.select(*by).distinct().write.mode("errorifexists").parquet(f"{path}/groups")
    # the one value of a cell first, spread over tasks; then at most a block's columns come together
    cells = df.filter(col(key).isNotNull()).select(*by, col(key).cast("string").alias("key"), col(value).alias("_value")) \
        .join(keys, "key").groupBy(*by, "block", "place").agg(_one_value("_value").alias("_value")).filter(F.col("_value").isNotNull())
    cells.groupBy(*by, "block").agg(F.sort_array(F.collect_list(F.struct("place", F.col("_value").alias("value")))).alias("cells")) \
        .write.mode("errorifexists").partitionBy("block").parquet(f"{path}/cells")


def _cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/cells").withColumn("cells", F.map_from_entries("cells"))


def read_keys(spark: SparkSession, path: str, keys: Sequence[str], index: Sequence[str]) -> DataFrame:
    """Some keys as columns, a row per group: only the blocks that hold them are read."""
    where = {r["key"]: (r["block"], r["place"]) for r in spark.read.parquet(f"{path}/keys").filter(F.col("key").isin(list(keys))).collect()}
    missing = [k for k in keys if k not in where]
    if missing:
        raise KeyError(f"no such keys: {missing}")
    groups = spark.read.parquet(f"{path}/groups")
    if not where:
        return groups.select(*[col(i) for i in index])
    own = _cells(spark, path).filter(F.col("block").isin(sorted({b for b, _ in where.values()})))
    # a group has one row per block: each column comes from one of them
    found = own.groupBy(*[col(i).alias(f"_k{n}") for n, i in enumerate(index)]).agg(
        *[F.max(F.when(F.col("block") == b, F.try_element_at("cells", F.lit(p)))).alias(k) for k, (b, p) in where.items()])
    on = [groups[i].eqNullSafe(found[f"_k{n}"]) for n, i in enumerate(index)]
    return groups.join(found, on, "left").select(*[groups[i] for i in index], *[col(k) for k in keys])


def read_block(spark: SparkSession, path: str, block: int, index: Sequence[str]) -> DataFrame:
    """One block as a wide table under its keys' names, in their order."""
    names = [r["key"] for r in spark.read.parquet(f"{path}/keys").filter(F.col("block") == block).orderBy("place").collect()]
    return read_keys(spark, path, names, index)


def read_long(spark: SparkSession, path: str, index: Sequence[str], key_col: str = "key", value_col: str = "value") -> DataFrame:
    """All blocks back as long results (index, key, value), without the empty cells."""
    keys = spark.read.parquet(f"{path}/keys")
    long = spark.read.parquet(f"{path}/cells").select(*[col(i) for i in index], "block", F.inline("cells"))
    return long.join(keys, ["block", "place"]).select(*[col(i) for i in index], F.col("key").alias(key_col), F.col("value").alias(value_col))
