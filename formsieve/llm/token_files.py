"""Operator 9: token ids in Arrow files of fixed-size lists.

Documents are encoded where they are read; shards are ranges of document ids, cut at a sample's quantiles, and each task sorts and writes
one shard: an Arrow file whose batches hold ``ids`` (fixed-size list of ``row_len`` ids,
uint16 or uint32 by vocabulary size) and ``mask`` (fixed-size list of booleans, true where
an id stands).  All rows have equal length and all batches but the last equal row counts,
so id ``k`` of a shard is at row ``k // row_len`` of batch ``row // batch_rows``: a reader
maps the file and takes a slice without copying.  Only a shard's last row is padded.
Beside it stands a small Arrow file with one row per document: id, first id's place in the
shard, number of ids.

A task names its files anew in each attempt and returns the names, so a repeated or
speculative task never touches another attempt's files; the manifest (one row per shard)
is saved, and only files it names are read.  Shards are streamed: a task holds one batch.

Edge cases: null and empty texts give the end id alone; a null id sorts first; rows with
the same id are separate documents, ordered by a hash of the text, then by their ids; an empty table gives no shards; other
columns are not read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved, shared_path, slices
from .word_ids import ENCODE_BYTES, word_ids

ROW_LEN = 2048
#: Rows that decide where shards start (shards of equal size, but for the sample's error).
SAMPLE = 50_000
#: Documents that a shard of a small table has at least.
LEAST_DOCS = 500
BATCH_ROWS = 64
MANIFEST = "shard long, token_file string, doc_file string, n_docs long, n_ids long"


def _open(path: str):
    """(file system, path on it) of a URI or plain path; works in any task."""
    path = re.sub("^s3[an]://", "s3://", path)  # Hadoop's names for one store
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class ShardWriter:
    """Streams ids into one token file."""

    def __init__(self, sink, dtype: np.dtype, row_len: int, batch_rows: int):
        self.item = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
        self.dtype, self.row_len, self.size = dtype, row_len, row_len * batch_rows
        self.schema = pa.schema([("ids", pa.list_(self.item, row_len)), ("mask", pa.list_(pa.bool_(), row_len))],
                                metadata={"row_len": str(row_len), "batch_rows": str(batch_rows)})
        self.out, self.held, self.n = pa.ipc.new_file(sink, self.schema), bytearray(), 0

    def _write(self, ids: np.ndarray) -> None:
        pad = -len(ids) % self.row_len
        full = np.concatenate([ids, np.zeros(pad, self.dtype)])
        mask = np.arange(len(full)) < len(ids)
        self.out.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(full, self.item), self.row_len),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), self.row_len)], schema=self.schema))

    def add(self, ids: bytes | pa.Buffer) -> None:
        self.held += ids
        self.n += len(ids) // self.dtype.itemsize
        step = self.size * self.dtype.itemsize
        while len(self.held) >= step:
            self._write(np.frombuffer(bytes(self.held[:step]), self.dtype))
            del self.held[:step]

    def close(self) -> None:
        if self.held:
            self._write(np.frombuffer(bytes(self.held), self.dtype))
        self.out.close()


class ShardReader:
    """Slices of one token file by place, from the mapped file where it is local."""

    def __init__(self, path: str):
        where, at = _open(path)
        self.file = pa.memory_map(at) if isinstance(where, fs.LocalFileSystem) else where.open_input_file(at)
        self.reader = pa.ipc.open_file(self.file)
        meta = self.reader.schema.metadata
        self.row_len, self.batch_rows = int(meta[b"row_len"]), int(meta[b"batch_rows"])
        self.at, self.ids = -1, None

    def slice(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids at [start, start + n), batch by batch, without copying."""
        step = self.row_len * self.batch_rows
        while n > 0:
            if (at := start // step) != self.at:
                column = self.reader.get_batch(at).column(0)
                self.at, self.ids = at, column.values.to_numpy(zero_copy_only=True)
            took = self.ids[start % step:start % step + n]
            yield took
            start, n = start + len(took), n - len(took)

    def close(self) -> None:
        self.ids = None
        self.file.close()


def shard_starts(docs: DataFrame, parts: int, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> list[tuple]:
    """Where each shard but the first starts, as (has an id, id, hash of the text), from about ``sample`` rows.

    A row is drawn by its place in the scan, so however often an id or a text repeats the sample keeps its size."""
    n = docs.count()
    every, parts = max(1, n // sample), min(parts, max(1, n // LEAST_DOCS))
    drawn = docs.where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(every)) == 0).select(id_col, F.xxhash64(text_col)).collect()
    keys = sorted((x is not None, x if x is not None else 0, t) for x, t in drawn)
    return [keys[len(keys) * i // parts] for i in range(1, parts)] if keys else []


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 1,
                      row_len: int = ROW_LEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes shards in ascending id order; returns the saved manifest, with ``start``, the
    number of ids in the shards before."""
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "tokens")
    id_type = docs.schema[id_col].dataType

    cuts = shard_starts(docs, int(spark.conf.get("spark.sql.shuffle.partitions")), id_col, text_col)
    parts = len(cuts) + 1

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        for b in slices(batches, size=ENCODE_BYTES):
            shard = [bisect_right(cuts, (True, x, t) if x is not None else (False, 0, t))
                     for x, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(encoder.batch(b.column(1)), pa.binary()), pa.array(shard, pa.int32())],
                                             names=[id_col, "tie", "ids", "shard"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = word_ids(tokenizer).dtype
        end = np.array([end_id], dtype).tobytes()
        tokens, index, names, n_docs = None, None, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            if tokens is None:
                names = [f"{folder}/{kind}-{uuid.uuid4().hex}.arrow" for kind in ("ids", "docs")]
                where, _ = _open(folder)
                where.create_dir(_open(folder)[1], recursive=True)
                sinks = [where.open_output_stream(_open(x)[1]) for x in names]
                tokens = ShardWriter(sinks[0], dtype, row_len, BATCH_ROWS)
                index = pa.ipc.new_file(sinks[1], index_schema(b))
            starts, sizes, ids = [], [], b.column(1)
            for i in range(b.num_rows):
                starts.append(tokens.n)
                tokens.add(ids[i].as_buffer())
                tokens.add(end)
                sizes.append(tokens.n - starts[-1])
            index.write_batch(pa.RecordBatch.from_arrays([b.column(0), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], schema=index_schema(b)))
            n_docs += b.num_rows
        if tokens is not None:
            tokens.close()
            index.close()
            for s in sinks:
                s.close()
            yield pa.RecordBatch.from_pydict({"shard": [TaskContext.get().partitionId()], "token_file": [names[0]], "doc_file": [names[1]],
                                              "n_docs": [n_docs], "n_ids": [tokens.n]})

    def index_schema(b: pa.RecordBatch) -> pa.Schema:
        return pa.schema([("doc", b.schema.field(0).type), ("start", pa.int64()), ("n", pa.int64())])

    # ids are half the size of texts, and the shuffle moves them instead; every row knows its shard, so nothing is sampled from encoded rows
    kept = T.StructType([T.StructField(id_col, id_type), T.StructField("tie", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("shard", T.IntegerType())])
    encoded = docs.select(id_col, text_col, F.xxhash64(text_col).alias("tie")).mapInArrow(encode, kept)
    manifest = saved(encoded.repartitionById(parts, "shard").sortWithinPartitions(F.col(id_col).asc_nulls_first(), "tie", "ids")
                     .select(id_col, "ids").mapInArrow(write, MANIFEST), "manifest")
    # one row per shard: the window holds as many rows as there were tasks
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(spark: SparkSession, manifest: DataFrame, id_type: T.DataType, id_col: str = "doc_id") -> DataFrame:
    """Reads every document back from the shards: (id, start, n_tokens, ids_crc32)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                where, at = _open(row["doc_file"])
                shard = ShardReader(row["token_file"])
                with where.open_input_file(at) as f:
                    index = pa.ipc.open_file(f)
                    for i in range(index.num_record_batches):
                        docs, crcs = index.get_batch(i), []
                        for start, n in zip(docs.column(1).to_pylist(), docs.column(2).to_pylist()):
                            crc = 0
                            for ids in shard.slice(start, n):
                                crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                            crcs.append(crc)
                        starts = docs.column(1).to_numpy() + row["start"]
                        yield pa.RecordBatch.from_arrays([docs.column(0), pa.array(starts, pa.int64()), docs.column(2), pa.array(crcs, pa.int64())],
                                                         names=[id_col, "start", "n_tokens", "ids_crc32"])
                shard.close()

    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    n = max(1, manifest.count())
    # a task per shard: the count is given, so small rows are not coalesced into one task
    return manifest.repartitionByRange(n, "shard").mapInArrow(read, schema)
