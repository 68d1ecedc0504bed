"""Operator 3: hierarchical residual best-fit packing.

1. Each task encodes its documents, adds the end id, cuts only documents longer than the
   capacity, and packs its pieces best-fit-decreasing into sequences.
2. Sequences filled to at least ``full_at`` are emitted.  The others go on as items whose
   size is their fill and whose members are the sequences they were made of.
3. Rounds of a tree merge items: as many partitions as items allow (``fan_in`` items
   each), best-fit again, full ones out, the rest one level up.  The tree ends when one
   partition is left, or when a round merges almost nothing (under ``min_gain`` of its
   items), which means no two remaining items fit together; all remaining sequences are
   then emitted as they are.

Placements are per sequence, not per document, and are joined to the pieces at the end.
A task packs at most ``block`` pieces at a time, so its memory is bounded; no round holds
more than ``fan_in`` items in a task unless hashing is uneven.  Piece and placement tables are saved in
the shared folder, so a lost executor repeats single tasks with the same sequence numbers.

Edge cases: null and empty texts are the end id alone; null ids and repeated rows are
packed like others, each row by itself; an empty table gives no pieces; a document of
exactly the capacity is one piece; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved, slices
from .word_ids import ENCODE_BYTES, word_ids

CAPACITY = 2048
FULL_AT = 0.995
FAN_IN = 50_000
BLOCK = 400_000
MIN_GAIN = 0.005


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each item, offset of each item, fill of each bin), best-fit-decreasing.

    Bins with the same room left share a stack; a bit mask of the rooms in use finds the
    tightest room that is large enough in one step."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    fills: list[int] = []
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = used >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                used &= ~(1 << room)
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += size
        if left := room - size:
            rooms[left].append(b)
            used |= 1 << left
    return bins, offsets, np.array(fills, np.int64)


def _pieces(ids: bytes, dtype: np.dtype, end: int, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32 of its ids as 32-bit little-endian) of one document."""
    full = np.append(np.frombuffer(ids, dtype), np.array([end], dtype)).astype("<u4")
    for k, start in enumerate(range(0, len(full), capacity)):
        part = full[start:start + capacity]
        yield k, start, len(part), zlib.crc32(part.tobytes())


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, full_at: float = FULL_AT,
         fan_in: int = FAN_IN, block: int = BLOCK, min_gain: float = MIN_GAIN,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset), a row per piece."""
    names = [id_col, "piece", "start", "length", "ids_crc32", "seq", "at", "fill"]
    least = int(np.ceil(full_at * capacity))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_ids(tokenizer), TaskContext.get().partitionId()
        next_bin = part << 36

        def flush(id_parts: list, rows: list, owners: list) -> pa.RecordBatch:
            nonlocal next_bin
            piece, start, length, crc = (np.array(x, np.int64) for x in zip(*rows))
            bins, at, fills = best_fit(length, capacity)
            ids = pa.concat_arrays(id_parts).take(pa.array(owners, pa.int64()))
            out = pa.RecordBatch.from_arrays(
                [ids, *(pa.array(x, t) for x, t in ((piece, pa.int32()), (start, pa.int64()), (length, pa.int64()), (crc, pa.int64()),
                                                    (bins + next_bin, pa.int64()), (at, pa.int64()), (fills[bins], pa.int64())))], names=names)
            next_bin += len(fills)
            return out

        id_parts, rows, owners, seen = [], [], [], 0
        for b in slices(batches, size=ENCODE_BYTES):
            id_parts.append(b.column(0))
            for k, ids in enumerate(encoder.batch(b.column(1))):
                for row in _pieces(ids, encoder.dtype, end_id, capacity):
                    rows.append(row)
                    owners.append(seen + k)
            seen += b.num_rows
            if len(rows) >= block:
                yield flush(id_parts, rows, owners)
                id_parts, rows, owners, seen = [], [], [], 0
        if rows:
            yield flush(id_parts, rows, owners)

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
                           *(T.StructField(c, T.LongType()) for c in names[2:])])
    pieces = saved(docs.select(id_col, text_col).mapInArrow(local, schema), "pieces")

    # an item: its size, and the sequences it holds with their offsets in it
    items = pieces.where((F.col("at") == 0) & (F.col("fill") < least)).select(
        F.col("seq").alias("item"), F.col("fill").alias("size"),
        F.array(F.struct(F.col("seq"), F.lit(0).cast("long").alias("base"))).alias("members"))
    placed, count = [], items.count()
    while count > 1:
        parts = -(-count // fan_in)
        # a hash deals sizes evenly; the same item always goes to the same task
        dealt = items.repartition(parts, F.xxhash64("item", F.lit(len(placed))))
        merged = saved(dealt.mapInArrow(lambda it: _merge(it, capacity), items.schema), "round")
        after = merged.count()
        if parts == 1 or after > (1 - min_gain) * count:
            placed.append(merged)
            items = None
            break
        placed.append(merged.where(F.col("size") >= least))
        items = merged.where(F.col("size") < least)
        count = items.count()
    if items is not None:
        placed.append(items)

    where = None
    for p in placed:
        one = p.select(F.col("item").alias("sequence_id"), F.inline("members"))
        where = one if where is None else where.unionByName(one)
    return (pieces.join(where, "seq", "left")
            .select(id_col, "piece", "start", "length", "ids_crc32", F.coalesce("sequence_id", "seq").alias("sequence_id"),
                    (F.col("at") + F.coalesce("base", F.lit(0))).alias("offset")))


def _merge(batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    """One task of a round: packs items best-fit; a new item takes its first member's number."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held).sort_by("item").combine_chunks()
    names, sizes = t.column("item").to_numpy(), t.column("size").to_numpy()
    members = t.column("members").combine_chunks()
    if isinstance(members, pa.ChunkedArray):
        members = members.chunk(0)
    counts = np.diff(members.offsets.to_numpy())
    flat = members.flatten()
    bins, at, fills = best_fit(sizes, capacity)
    owner = np.repeat(np.arange(len(sizes)), counts)
    seq, base = flat.field("seq").to_numpy(), flat.field("base").to_numpy() + at[owner]
    order = np.lexsort((base, bins[owner]))
    ends = np.concatenate([[0], np.cumsum(np.bincount(bins[owner], minlength=len(fills)))])
    first = names[np.flatnonzero(at == 0)]
    by_bin = np.empty(len(fills), np.int64)
    by_bin[bins[at == 0]] = first
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(seq[order], pa.int64()), pa.array(base[order], pa.int64())], names=["seq", "base"]))
    yield pa.RecordBatch.from_arrays([pa.array(by_bin, pa.int64()), pa.array(fills, pa.int64()), lists], names=["item", "size", "members"])
