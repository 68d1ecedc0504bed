"""Master tables kept by key.

A master grows with every run and each run touches few of its rows, so moving it is the
cost to avoid.  A bucketed table keeps it dealt by the hash of its key: an append or a
correction then moves only the batch or the log to the buckets, the join reads each
bucket where it is, and what is written back stays in its bucket, without a shuffle.

The table is external: its files are under ``path`` (a shared folder), its entry in the
session's catalog.  The number of buckets is fixed when the table is first written;
:func:`buckets_for` takes it from the size a bucket may have.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

from formsieve.functions.nulls import col
from formsieve.operators import joins
from formsieve.operators.corrections import apply_log, change_trail, undo
from formsieve.operators.reshape import union_onto_template

#: Bytes of one bucket that one task reads.
BUCKET_BYTES = 1 << 30
MOST_BUCKETS = 100_000


def buckets_for(n_bytes: int, bucket_bytes: int = BUCKET_BYTES, growth: float = 2.0) -> int:
    """Buckets for a table that will grow to ``growth`` times its present size."""
    return int(min(MOST_BUCKETS, max(1, math.ceil(n_bytes * growth / bucket_bytes))))


def _save(df: DataFrame, name: str, key: str, buckets: int, path: str, mode: str) -> None:
    # one Parquet file per task and bucket: the caller's tasks hold one bucket each
    df.write.mode(mode).format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def create_master(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Writes ``df`` as the bucketed table ``name`` and returns it: the one shuffle of its life."""
    _save(df.repartition(buckets, col(key)), name, key, buckets, path, "errorifexists")
    return df.sparkSession.table(name)


def bucketing(spark: SparkSession, name: str) -> tuple[str, int]:
    """(key, number of buckets) of a bucketed table."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    keys = rows.get("Bucket Columns", "[]").strip("[]").replace("`", "").split(", ")
    if "Num Buckets" not in rows or len(keys) != 1 or not keys[0]:
        raise ValueError(f"{name} is not bucketed by one column")
    return keys[0], int(rows["Num Buckets"])


def dealt_like(df: DataFrame, name: str, key_col: str | None = None) -> DataFrame:
    """``df`` dealt by ``key_col`` (the master's key if not given) as the master is.

    Asked for by number: left alone, Spark would deal the small side to
    ``spark.sql.shuffle.partitions`` and, where these are more than the buckets, the master too."""
    key, buckets = bucketing(df.sparkSession, name)
    return df.repartition(buckets, col(key_col or key))


def new_rows(batch: DataFrame, name: str) -> DataFrame:
    """The batch's rows whose key the master doesn't hold.  Only the batch is shuffled."""
    spark = batch.sparkSession
    key, _ = bucketing(spark, name)
    return joins.new_rows_only(dealt_like(batch, name), spark.table(name), key)


def append_new(batch: DataFrame, name: str) -> DataFrame:
    """J6 + U2: appends the batch's new rows to the master and returns the grown table.

    The batch's columns are brought to the master's order and types; columns the master
    doesn't have are refused (widening a master is a new table, see :func:`create_master`)."""
    spark = batch.sparkSession
    master = spark.table(name)
    key, buckets = bucketing(spark, name)
    extra = [c for c in batch.columns if c not in master.columns]
    if extra:
        raise ValueError(f"columns that {name} doesn't have: {extra}")
    rows = new_rows(union_onto_template(master.limit(0), [batch]), name)
    path = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
    _save(rows, name, key, buckets, path, "append")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def corrected(name: str, log: DataFrame, **log_columns) -> DataFrame:
    """The master with an edited log applied.  Only the log is shuffled."""
    spark = log.sparkSession
    key, _ = bucketing(spark, name)
    return apply_log(spark.table(name), dealt_like(log, name), id_col=key, **log_columns)


def corrections_trail(name: str, log: DataFrame, **log_columns) -> DataFrame:
    """The change trail of :func:`corrected`."""
    spark = log.sparkSession
    key, _ = bucketing(spark, name)
    return change_trail(spark.table(name), dealt_like(log, name), id_col=key, **log_columns)


def undone(name: str, trail: DataFrame) -> DataFrame:
    """The master before the corrections that left ``trail``.  Only the trail is shuffled."""
    spark = trail.sparkSession
    key, _ = bucketing(spark, name)
    return undo(spark.table(name), dealt_like(trail, name), id_col=key)


def rewrite(df: DataFrame, source: str, name: str, path: str) -> DataFrame:
    """Writes rows computed from the master ``source`` (corrections, a compaction) as the
    next table ``name``, bucketed alike.

    Rows that still lie in their buckets are written where they are; files of several
    appends become one sorted file per bucket."""
    key, buckets = bucketing(df.sparkSession, source)
    _save(df, name, key, buckets, path, "errorifexists")
    return df.sparkSession.table(name)

