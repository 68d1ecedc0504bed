"""Helpers shared by the operators of this package."""

from __future__ import annotations

import functools
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formsieve.session import checkpoint_dir

#: The white space of the contracts, ``[\x20\x09-\x0D]``; ``bytes.split()`` uses the same set.
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names in ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Tables that this process has written for itself, by ``saved``.
WRITTEN: list[str] = []


def remove_saved(spark: SparkSession) -> int:
    """Removes the tables that ``saved`` wrote, and returns their number.

    For the end of a job, when no DataFrame that reads them is needed any more: results are lazy and read
    them again.  Files that were asked for (token files) are not among them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    n = 0
    while WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(WRITTEN.pop())
        n += path.getFileSystem(conf).delete(path, True)
    return n


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back.

    Cuts the lineage like ``checkpoint()`` (a lost executor repeats tasks, not the jobs
    before this one), but columnar and compressed, so later reads take the columns they use.
    ``remove_saved`` removes such tables."""
    path = shared_path(df.sparkSession, name)
    WRITTEN.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def helpers_apart(operator):
    """For operators that return the columns of ``docs``: helper columns begin with two underscores, and
    columns of ``docs`` that do so too (ids and texts may not) get other names on the way."""

    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        theirs = {c: f"column {i} {c.strip('_')}" for i, c in enumerate(docs.columns) if c.startswith("__")}
        out = operator(docs.withColumnsRenamed(theirs), *args, **options)
        return out.withColumnsRenamed({b: a for a, b in theirs.items()})

    return run


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other letter left alone."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def strip_space(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE))


def crc_rest(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null id: the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def in_fold(doc_id, n: int, rest: int) -> bool:
    """``crc_rest`` for one id in Python."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n == rest


def byte_texts(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


#: Text that a task turns into Python objects at a time; a longer single text is a slice of its own.
SLICE_BYTES = 1 << 20


def slices(batches: Iterator[pa.RecordBatch], text: int = 1, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``size`` bytes of the text column, so that words
    of thousands of documents never stand in memory together."""
    for b in batches:
        if not b.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // size
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), b.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            yield b.slice(s, e - s)
