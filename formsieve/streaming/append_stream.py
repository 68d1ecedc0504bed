"""Incremental append of arriving batches to a master table (J6 + U1 over a stream).

The workflow appends each new batch to the master with an anti-join on ``uuid`` and a
union by name.  As a Structured Streaming job, batch files landing in a folder are
read with a declared schema and every micro-batch runs the same two operators inside
``foreachBatch``.  The anti-join makes a replayed micro-batch (after a failure)
append nothing twice, so the sink is idempotent without extra state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from formsieve.operators.joins import new_rows_only


def append_batch(spark: SparkSession, batch: DataFrame, master_path: str, key: str = "uuid") -> int:
    """J6 + U1 for one batch: rows with a new key are appended to the master (parquet).
    Returns the number of rows written."""
    try:
        master = spark.read.parquet(master_path)
        new = new_rows_only(batch, master, key)
    except Exception as e:  # the master does not exist yet: every row is new
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        new = batch
    new = new.cache()
    n = new.count()
    if n:
        new.write.mode("append").option("mergeSchema", "true").parquet(master_path)
    new.unpersist()
    return n


def start_append_stream(spark: SparkSession, source_dir: str, schema: T.StructType, master_path: str,
                        checkpoint_location: str, key: str = "uuid", fmt: str = "parquet",
                        available_now: bool = True) -> StreamingQuery:
    """Watch ``source_dir`` for batch files and append their new rows to the master."""
    stream = spark.readStream.schema(schema).format(fmt).load(source_dir)
    writer = (stream.writeStream
              .foreachBatch(lambda df, epoch_id: append_batch(spark, df, master_path, key))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
