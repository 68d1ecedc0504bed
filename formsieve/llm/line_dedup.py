"""Operator 7: duplicate lines across documents.

A line's key is the line stripped of white space with A-Z lowered; keys of at least
``min_chars`` code points found in at least ``min_docs`` documents keep their lines only in
the largest doc id that holds them.

1. Lines become (128-bit hash, doc id, position): no text is shuffled.
2. They are range-partitioned by hash with doc id (largest first) and position as secondary sort, so a
   hash that holds a third of all lines spreads over many tasks.
3. Each task streams its sorted rows.  For a hash that lies wholly inside the task it
   decides at once.  A task's first and last hash may continue in a neighbour: their
   rows go on as *pending*, and the task adds up to ``min_docs`` distinct largest doc
   ids of each - at most two such rows per task, so the merged table of boundary hashes
   is bounded by the number of tasks and is broadcast.
4. Dropped positions are gathered per document (bounded by its lines) into a
   zlib-compressed bitmap of kept lines.

Edge cases: a null or empty text is one empty line, kept; a null doc id is smaller than
any other and counts as one document; rows that share a doc id are one document for
counting, and lines are dropped per (doc id, text), so equal rows lose equal lines; an
empty table gives an empty result; other
columns are passed through by ``drop_lines`` and not read otherwise.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, helpers_apart, lower_ascii, saved, slices, strip_space

MIN_CHARS = 20
MIN_DOCS = 3
#: A null doc id's place in the order: below every other.
NO_ID = -(1 << 63)
NAMES = ["h1", "h2", "doc", "pos", "txt", "top"]
STREAMED = "h1 long, h2 long, doc long, pos int, txt long, top array<long>"


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(h1, h2, doc, pos, txt) of every line whose key is long enough."""
    key = lower_ascii(strip_space(F.col("line")))
    return (docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.col(text_col).alias("text"),
                         F.xxhash64(text_col).alias("txt"))
            .where(F.length("text") >= min_chars)
            .select("doc", "txt", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
            .where(F.length("line") >= min_chars)
            .select("doc", "txt", "pos", key.alias("key")).where(F.length("key") >= min_chars)
            # two hashes with different first values: 128 bits, so that no two of 10^13 lines meet
            .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "doc", "pos", "txt"))


def _rows(h1, h2, doc, pos, txt, top=None) -> pa.RecordBatch:
    lists = pa.nulls(len(h1), pa.list_(pa.int64())) if top is None else pa.array(top, pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(doc, pa.int64()),
                                       pa.array(pos, pa.int32()), pa.array(txt, pa.int64()), lists], names=NAMES)


def _stream(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows in, decisions out.  ``pos`` >= 0 and no ``top``, hash null: a dropped line;
    hash given: a pending line; ``top``: a boundary hash's largest doc ids in this task.

    Rows of one hash are held until it ends, and only while it has fewer than ``min_docs``
    distinct documents; from then on its rows (but the first document's) are emitted as
    they come."""
    first = True          # the current hash is the task's first
    cur, docs = None, []  # current hash; its distinct doc ids, at most min_docs
    held: list[np.ndarray] = []  # rows of the current hash that are not decided yet

    def drops(doc, pos, txt):
        none = pa.nulls(len(doc), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, pa.array(doc, pa.int64()), pa.array(pos, pa.int32()), pa.array(txt, pa.int64()),
                                           pa.nulls(len(doc), pa.list_(pa.int64()))], names=NAMES)

    def pending(rows):
        return _rows(np.full(len(rows), cur[0]), np.full(len(rows), cur[1]), *rows.T)

    for b in batches:
        if not b.num_rows:
            continue
        h1, h2, doc, pos, txt = (b.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        rows = np.stack([doc, pos.astype(np.int64), txt], 1)
        new = np.flatnonzero((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])) + 1
        starts, ends = np.concatenate([[0], new]), np.concatenate([new, [len(h1)]])
        # hashes wholly inside this batch, in one go: neither its first nor its last
        inner = slice(1, len(starts) - 1)
        parts = [0] if len(starts) == 1 else [0, len(starts) - 1]
        for g in parts:
            s, e = starts[g], ends[g]
            if (h1[s], h2[s]) != cur:
                if cur is not None:  # the hash before has ended
                    if first:
                        yield _rows([cur[0]], [cur[1]], [docs[0]], [-1], [0], [docs])
                        for r in held:
                            yield pending(r)
                    elif len(docs) >= min_docs and held:
                        r = np.concatenate(held)
                        r = r[r[:, 0] != docs[0]]
                        yield drops(*r.T)
                    first = False
                cur, docs, held = (h1[s], h2[s]), [], []
            seg = rows[s:e]
            if len(docs) < min_docs:
                docs = list(dict.fromkeys([*docs, *np.unique(seg[:, 0])[::-1][:min_docs].tolist()]))[:min_docs]
            held.append(seg)
            if first:
                for r in held:
                    yield pending(r)
                held = []
            elif sum(map(len, held)) > 100_000 and len(docs) >= min_docs:
                # it may still be the task's last hash, whose largest doc id is known: it came first in this task
                r = np.concatenate(held)
                yield drops(*r[r[:, 0] != docs[0]].T)
                held = []
            if g == 0 and len(starts) > 2:
                s, e = starts[1], ends[len(starts) - 2]
                group = np.repeat(np.arange(len(starts) - 2), (ends - starts)[inner])
                d = doc[s:e]
                fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (d[1:] != d[:-1])])
                head = np.concatenate([[True], group[1:] != group[:-1]])
                n_docs = np.bincount(group, weights=fresh).astype(int)
                gone = (n_docs[group] >= min_docs) & (d != d[np.flatnonzero(head)][group])
                if gone.any():
                    yield drops(*rows[s:e][gone].T)
    if cur is not None:
        yield _rows([cur[0]], [cur[1]], [docs[0]], [-1], [0], [docs])
        for r in held:
            yield pending(r)


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, txt, pos) of every line that goes; ``doc`` is ``NO_ID`` for a null id."""
    order = ["h1", "h2", F.col("doc").desc(), "pos"]
    # the range partitions' sample and the shuffle both read the hashes: they are taken once
    lines = saved(line_hashes(docs, min_chars, id_col, text_col), "line_hashes")
    out = saved(lines.repartitionByRange(*order).sortWithinPartitions(*order)
                .mapInArrow(lambda it: _stream(it, min_docs), STREAMED), "lines")
    # at most two rows per task, so this table is bounded by the number of tasks
    bounds = (out.where(F.col("top").isNotNull()).groupBy("h1", "h2")
              .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("top"))), asc=False).alias("top"))
              .where(F.size("top") >= min_docs).select("h1", "h2", F.col("top")[0].alias("keeper")))
    rows = out.where(F.col("top").isNull())
    pending = (rows.where(F.col("h1").isNotNull()).join(F.broadcast(bounds), ["h1", "h2"])
               .where(F.col("doc") != F.col("keeper")))
    return rows.where(F.col("h1").isNull()).select("doc", "txt", "pos").unionByName(pending.select("doc", "txt", "pos"))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, txt, keep): for each document that loses lines, a zlib-compressed bitmap with a
    bit per line up to its last dropped one, most significant bit first, 1 = kept."""
    gone = dropped_lines(docs, min_chars, min_docs, id_col, text_col)

    def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            maps = []
            for positions in b.column(2).to_pylist():
                keep = np.ones(max(positions) + 1, np.uint8)
                keep[positions] = 0
                maps.append(zlib.compress(np.packbits(keep).tobytes() + len(keep).to_bytes(8, "little"), 1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(maps, pa.binary())], names=["doc", "txt", "keep"])

    return gone.groupBy("doc", "txt").agg(F.collect_set("pos").alias("gone")).mapInArrow(bitmaps, "doc long, txt long, keep binary")


def kept_lines(text: bytes | None, bitmap: bytes | None) -> tuple[list[bytes], int]:
    """(lines that stay, number of lines) of one text."""
    lines = (text or b"").split(b"\n")
    if bitmap is None:
        return lines, len(lines)
    raw = zlib.decompress(bitmap)
    n = int.from_bytes(raw[-8:], "little")
    keep = np.unpackbits(np.frombuffer(raw[:-8], np.uint8))[:n].tolist()
    return [x for x, k in zip(lines[:n], keep) if k] + lines[n:], len(lines)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``__keep``."""
    keyed = docs.withColumns({"__doc": F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), "__txt": F.xxhash64(text_col)})
    maps = bitmaps.toDF("__doc", "__txt", "__keep")
    return keyed.join(maps, ["__doc", "__txt"], "left").drop("__doc", "__txt")


def digests(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_dropped, kept_sha256) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            kept = [kept_lines(t, k) for t, k in zip(byte_texts(b.column(1)), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for _, n in kept], pa.int64()), pa.array([n - len(x) for x, n in kept], pa.int64()),
                 pa.array([hashlib.sha256(b"\n".join(x)).hexdigest() for x, _ in kept], pa.string())],
                names=[id_col, "n_lines", "n_dropped", "kept_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (with_bitmaps(docs.select(id_col, text_col), bitmaps, id_col, text_col).select(id_col, text_col, "__keep")
            .mapInArrow(run, f"`{id_col}` {kind}, n_lines long, n_dropped long, kept_sha256 string"))


@helpers_apart
def drop_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the dropped lines taken out of the text; a null text stays null."""
    cols = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = cols.index(text_col)
        for b in slices(batches, at):
            texts = [None if t is None else t if k is None else b"\n".join(kept_lines(t, k)[0])
                     for t, k in zip(byte_texts(b.column(at)), b.column(len(cols)).to_pylist())]
            out = [b.column(i) for i in range(len(cols))]
            out[at] = pa.array(texts, pa.binary()).cast(b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(out, names=cols)

    return with_bitmaps(docs, bitmaps, id_col, text_col).select(*cols, "__keep").mapInArrow(run, docs.schema)
