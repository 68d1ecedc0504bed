"""Operator 13: exact top-k search by integer inner product.

Components are scaled and floored to integers.  Queries are dealt into blocks and candidates
into shards; each (block, shard) pair is a tile.  A tile's task holds its queries (about
``QUERY_BYTES`` of them, a fixed bound), streams the shard's candidates past them in ascending
id order as tiled matrix products, and keeps ``k`` per query from each product.  A tile hands on one
list of ``k`` per query; lists of ``FAN`` neighbouring shards are merged at a time, up a tree.

Every query meets every candidate of its length: the work is their product by definition,
and the tiles bound what is shuffled for it: a query goes to each shard, a
candidate to each block of queries, no pair is ever a row.

Products are exact: where ``dims * max|q| * max|c|`` is below 2**53 they are sums of integers
that doubles hold, elsewhere they are taken with Python's integers (slower; a score beyond
the range of a long is the nearest long, and is ranked as such).

Edge cases: a vector that is null or empty or holds null or non-finite components takes no part, nor
does a null id or one that is no integer; a zero vector takes part (score 0); a query meets the vectors of its own length; rows of
one id are one vector, the smallest of them in binary order; equal scores go to the smaller id;
fewer than ``k`` candidates give all of them; an empty table or one without queries gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .vectors import matrices

#: Bytes of queries that a tile's task holds, and candidates that it streams, at most about.
QUERY_BYTES = 64 << 20
SHARD = 262_144
#: Tasks at most; with more tiles a task takes several, one after another.
MOST_TASKS = 100_000
#: Candidates of a shard of a small table (more shards than cores are not needed).
LEAST_SHARD = 4_096
#: Rows and columns of one matrix product.
TILE_QUERIES, TILE_POINTS = 512, 4_096
#: Lists merged at a time.
FAN = 16
#: No candidate yet; real scores are above it.
NONE = np.iinfo(np.int64).min

POINTS = "id long, dims int, vector binary"
LISTS = "query_id long, part long, score long, vec_id long"


def _integers(scale: float):
    """(id, length, floor(scale * component)) of the vectors that take part: 4 bytes a
    component where that is exact, else 8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, x in matrices(b.column(1)):
                x = np.floor(x * scale)
                small = np.abs(x).max(axis=1) <= 1 << 24
                for take, kind in ((small, "<f4"), (~small, "<f8")):
                    if take.any():
                        packed = np.ascontiguousarray(x[take].astype(kind))
                        yield pa.RecordBatch.from_arrays(
                            [b.column(0).take(pa.array(rows[take])), pa.array(np.full(len(packed), x.shape[1], np.int32)),
                             pa.array([r.tobytes() for r in packed], pa.binary())], names=["id", "dims", "vector"])

    return run


def _unpack(dims: int, vectors: pa.Array) -> np.ndarray:
    out = np.empty((len(vectors), dims))
    for i, v in enumerate(vectors.to_pylist()):
        out[i] = np.frombuffer(v, "<f4" if len(v) == 4 * dims else "<f8")
    return out


def products(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued rows, as longs."""
    if queries.shape[1] * np.abs(queries).max() * np.abs(points).max() < 1 << 53:
        return (queries @ points.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    most = np.iinfo(np.int64).max
    exact = whole(queries).astype(object) @ whole(points).astype(object).T
    return np.clip(exact, -most, most).astype(np.int64)


def select(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best (score, id) of each row, in order; among equal scores the earlier column.

    One partial selection finds each row's ``k``-th score; only columns that reach it are sorted."""
    n, m = scores.shape
    least = np.partition(scores, m - k, axis=1)[:, m - k]
    row, col = np.nonzero(scores >= least[:, None])
    order = np.lexsort((col, ~scores[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, np.arange(n))[row]
    keep = place < k
    row, col = row[keep].reshape(n, k), col[keep].reshape(n, k)
    return scores[row, col], ids[row, col]


class Tile:
    """One block of queries; candidates arrive in ascending id order."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x, k
        self.score = np.full((len(ids), k), NONE, np.int64)
        self.best = np.zeros((len(ids), k), np.int64)

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        for s in range(0, len(ids), TILE_POINTS):
            own, points = ids[s:s + TILE_POINTS], x[s:s + TILE_POINTS]
            for t in range(0, len(self.ids), TILE_QUERIES):
                part = slice(t, t + TILE_QUERIES)
                scores = products(self.x[part], points)
                at = np.minimum(np.searchsorted(own, self.ids[part]), len(own) - 1)
                self_ = np.flatnonzero(own[at] == self.ids[part])
                scores[self_, at[self_]] = NONE
                self.score[part], self.best[part] = select(
                    np.concatenate([self.score[part], scores], axis=1),
                    np.concatenate([self.best[part], np.broadcast_to(own, scores.shape)], axis=1), self.k)


def _search(k: int):
    """Top lists of every tile of a partition sorted by (tile, kind, id): queries (kind 0) come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, xs, tile = None, [], [], None

        def found():
            if tile is None:
                return
            row, col = np.nonzero(tile.score != NONE)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tile.ids[row]), pa.array(np.full(len(row), key[2])), pa.array(tile.score[row, col]), pa.array(tile.best[row, col])],
                names=["query_id", "part", "score", "vec_id"])

        for b in batches:
            keys = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(4)], axis=1)  # dims, block, shard, kind
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for s, e in zip(cuts, cuts[1:]):
                if s == e:
                    continue
                at, kind = tuple(keys[s, :3].tolist()), keys[s, 3]
                if at != key:
                    yield from found()
                    key, ids, xs, tile = at, [], [], None
                own, x = b.column(4).slice(s, e - s).to_numpy(), _unpack(key[0], b.column(5).slice(s, e - s))
                if kind == 0:
                    ids.append(own)
                    xs.append(x)
                    continue
                if tile is None and ids:
                    tile = Tile(np.concatenate(ids), np.concatenate(xs), k)
                if tile is not None:
                    tile.add(own, x)
        yield from found()

    return run


def merged(lists: DataFrame, parts: int, k: int) -> DataFrame:
    """(query_id, top) with the ``k`` best over all parts: rounds of at most ``FAN`` lists each."""
    # the negative score first: ascending order of the pair is the order of the answer
    out = lists.groupBy("query_id", "part").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("neg"), "vec_id"))).alias("top"))
    while parts > 1:
        parts = -(-parts // FAN)
        out = out.groupBy("query_id", F.expr(f"part div {FAN}").alias("part")).agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
    return out.select("query_id", "top")


def search(vectors: DataFrame, asks: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding",
           query_block: int | None = None, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest products of every row for which ``asks`` holds.
    ``query_block``: queries of a block, if not those that ``QUERY_BYTES`` hold."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).try_cast("long").alias(id_col), vector_col).filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
    ask_ids = F.coalesce(asks, F.lit(False))
    whole = rows.mapInArrow(_integers(scale), POINTS)
    points = saved(whole.groupBy("id").agg(F.min(F.struct("dims", "vector")).alias("v")).select(F.col("id").alias(id_col), "v.*")
                   .withColumn("asks", ask_ids), "topk_points")
    n, n_asks, dims = points.agg(F.count(F.lit(1)), F.count_if("asks"), F.max("dims")).first()
    query_block = query_block or max(1, QUERY_BYTES // (8 * (dims or 1)))
    blocks = max(1, -(-n_asks // query_block))
    shards = max(1, -(-n // shard), min(2 * spark.sparkContext.defaultParallelism, n // LEAST_SHARD))
    every = lambda count, name: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    dealt = lambda count, seed: F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(count)).cast("int")
    tiles = ["dims", "block", "shard"]
    queries = points.filter("asks").select("dims", dealt(blocks, 1).alias("block"), every(shards, "shard"), F.lit(0).alias("kind"), id_col, "vector")
    candidates = points.select("dims", every(blocks, "block"), dealt(shards, 2).alias("shard"), F.lit(1).alias("kind"), id_col, "vector")
    lists = queries.unionByName(candidates).repartition(min(blocks * shards, MOST_TASKS), *tiles).sortWithinPartitions(*tiles, "kind", id_col) \
        .mapInArrow(_search(k), LISTS)
    best = merged(lists, shards, k)
    return best.select("query_id", F.posexplode("top").alias("rank", "hit")) \
        .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.neg")).alias("score"))
