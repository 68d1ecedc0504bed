"""Operator 10: approximate nearest neighbours on shifted space-filling curves.

Equal vectors are one point, so copies take one place and no tie between them is lost.
Each of ``curves`` orderings projects the points on ``dims`` random orthonormal directions, shifts and scales
them to a grid and gives each its Hilbert key.  Each curve is range-partitioned by (key, id) into
blocks of about ``window`` points, so equal keys are split as well; a query is also sent to
the blocks before and after its own.  A block's task holds its queries, streams its points'
vectors past them and keeps the ``k`` nearest of each query by exact distance in double
precision, so nothing that a curve brought together is lost before the curves' findings merge.

The window is measured: ``PROBES`` queries get their exact nearest neighbours from one pass over all
points, a second pass counts the points before each of these on every curve, and the window is the smallest
(from ``least_window`` on, in steps of a half) in which ``target`` of the neighbours are in reach on some curve.
Clustered vectors keep the least window, so their work grows with the table; on
vectors without structure no curve brings neighbours together, and the window becomes a share of the table.

Bounds: ``SAMPLE`` vectors fit the projections' scales; blocks' boundaries come from ``PER_BLOCK`` sampled
keys a block, at most ``MAX_BLOCKS`` blocks a curve (larger tables get larger blocks, whose points are
streamed).  Every point is indexed.

Edge cases: a vector that is null, empty or zero, or holds null or non-finite components, takes no
part, nor does a null id; vectors of another than the most frequent length take no part;
repeated rows count once; fewer than ``k`` candidates give all of them if the curves find them (always for
tables of up to three windows); an empty table, or one without queries, gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved

CURVES = 24
DIMS = 12
BITS = 5
LEAST_WINDOW = 256
SAMPLE = 16_384
PER_BLOCK = 16
MAX_BLOCKS = 50_000
PROBES = 64
#: Share of the probes' neighbours that a window must reach; blocks reach further than the window by half on average.
TARGET = 0.95
SEED = 10


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of grid cells (n x dims, 0 <= cell < 2**bits), after Skilling (2004)."""
    x = cells.astype(np.int64).T.copy()
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(len(x)):
            hit = (x[i] & q) != 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(hit, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn, q = np.zeros(x.shape[1], np.int64), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for row in x:
            key = (key << 1) | ((row >> b) & 1)
    return key


class Curves:
    """Projections and shifts, with scales fitted on a bounded sample."""

    def __init__(self, sample: np.ndarray, curves: int, dims: int = DIMS, bits: int = BITS):
        rng = np.random.default_rng(SEED)
        dims = min(dims, sample.shape[1])
        self.bits, self.mean, self.n = bits, sample.mean(0), curves
        self.turn = [np.linalg.qr(rng.normal(size=(sample.shape[1], dims)))[0] for _ in range(curves)]
        self.scale = [np.maximum(((sample - self.mean) @ t).std(0), 1e-12) for t in self.turn]
        self.shift = [rng.uniform(3, 5, size=dims) for _ in range(curves)]

    def keys(self, x: np.ndarray, c: int) -> np.ndarray:
        grid = ((x - self.mean) @ self.turn[c] / self.scale[c] + self.shift[c]) / 8 * (1 << self.bits)
        return hilbert_key(np.clip(grid, 0, (1 << self.bits) - 1).astype(np.int64), self.bits)


PAIR = np.dtype([("k", np.int64), ("i", np.int64)])


def pairs(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Records (key, id), which compare by key, then id."""
    out = np.empty(len(keys), PAIR)
    out["k"], out["i"] = keys, ids
    return out


def upto(marks: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """How many of the sorted marks are not after each (key, id)."""
    out = np.searchsorted(marks["k"], keys, "right")
    tie = np.flatnonzero(np.searchsorted(marks["k"], keys, "left") != out)
    if len(tie):  # a mark on this very key: the id decides
        out[tie] = np.searchsorted(marks, pairs(keys[tie], ids[tie]), "right")
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and all components finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


KEYS = "curve int, key long, point long"
COUNTS = "curve int, slot int, n long"
NEAR = "query long, point long, score double"
BLOCKS = "place long, point long, vector binary"


def _keys(curves: Curves):
    """(curve, key, id) of every point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(1))
                for c in range(curves.n):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), c, np.int32)), pa.array(curves.keys(x, c)), b.column(0)],
                                                     names=["curve", "key", "point"])

    return run


def _counts(curves: Curves, marks: list[np.ndarray]):
    """(curve, slot, n): a task's number of points after ``slot`` of the marks, and before the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((curves.n, len(marks[0]) + 1), np.int64)
        for b in batches:
            if b.num_rows:
                ids, x = b.column(0).to_numpy(), _matrix(b.column(1))
                for c in range(curves.n):
                    n[c] += np.bincount(upto(marks[c], curves.keys(x, c), ids), minlength=n.shape[1])
        c, slot = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(slot, pa.int32()), pa.array(n[c, slot])], names=["curve", "slot", "n"])

    return run


class Asks:
    """Queries and the nearest points that they met so far, by (distance, id).

    Distances from one matrix product have an error, of at most ``slack`` times the squared norms (taken from the
    queries' mean); every point that may be among the nearest by that bound is measured by its differences."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, keep: int):
        self.ids, self.x, self.keep, self.mean = ids, x, keep, x.mean(0)
        self.near = x - self.mean
        self.norm, self.slack = (self.near * self.near).sum(1), (4 * x.shape[1] + 32) * np.finfo(np.float64).eps
        self.about, self.names = np.full((len(ids), keep), np.inf), np.full((len(ids), keep), -1, np.int64)

    def _exact(self, i: np.ndarray, x: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Squared distances of the pairs (i, j), summed in the components' order, so that they are equal wherever a pair meets."""
        step = max(1, (1 << 20) // x.shape[1])
        return np.concatenate([np.zeros(0), *(np.cumsum((self.x[i[s:s + step]] - x[j[s:s + step]]) ** 2, axis=1)[:, -1] for s in range(0, len(i), step))])

    def meet(self, ids: np.ndarray, x: np.ndarray) -> None:
        near = x - self.mean
        norm = (near * near).sum(1)
        for at in range(0, len(self.ids), 256):
            part = slice(at, at + 256)
            both = self.norm[part, None] + norm[None, :]
            d, slack = both - 2 * (self.near[part] @ near.T), self.slack * both
            own = self.ids[part, None] == ids[None, :]
            most = self.about[part].max(1)
            if len(ids) > self.keep:
                most = np.fmin(most, np.partition(np.where(own, np.inf, d + slack), self.keep - 1, axis=1)[:, self.keep - 1])
            i, j = np.nonzero(~(d - slack > most[:, None]) & ~own)
            if not len(i):
                continue
            rows = np.arange(len(d)).repeat(self.keep)
            row = np.concatenate([rows, i])
            about = np.concatenate([self.about[part].ravel(), self._exact(i + at, x, j)])
            names = np.concatenate([self.names[part].ravel(), ids[j]])
            order = np.lexsort((names, about, row))
            starts = np.searchsorted(row[order], np.arange(len(d)))
            take = order[(starts[:, None] + np.arange(self.keep)).ravel()]
            self.about[part], self.names[part] = about[take].reshape(-1, self.keep), names[take].reshape(-1, self.keep)

    def found(self) -> pa.RecordBatch:
        fine = np.isfinite(self.about)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(self.ids, self.keep)[fine.ravel()]), pa.array(self.names[fine]),
                                           pa.array(np.sqrt(self.about[fine]))], names=["query", "point", "score"])


def _probe(ids: np.ndarray, x: np.ndarray, k: int):
    """The probes' k nearest points of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asks = Asks(ids, x, k)
        for b in batches:
            if b.num_rows:
                asks.meet(b.column(0).to_numpy(), _matrix(b.column(1)))
        yield asks.found()

    return run


def _deal(curves: Curves, cuts: list[np.ndarray], blocks: int, kind: type):
    """Points to their blocks on every curve (odd places), queries to theirs and the blocks on
    either side (even places, so that they come first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids, x, asks = b.column(0).to_numpy(), _matrix(b.column(1)), b.column(2).to_numpy(zero_copy_only=False)
            packed = x.astype(kind)
            ends = np.arange(len(x) + 1, dtype=np.int32) * (packed.itemsize * x.shape[1])
            bytes_ = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(packed)])
            for c in range(curves.n):
                block = upto(cuts[c], curves.keys(x, c), ids)
                for step, odd, who in ((0, 1, True), (0, 0, asks), (-1, 0, asks), (1, 0, asks)):
                    to = block + step
                    take = np.flatnonzero((to >= 0) & (to < blocks) & who)
                    yield pa.RecordBatch.from_arrays([pa.array((to[take] + c * blocks) * 2 + odd, pa.int64()), pa.array(ids[take]),
                                                      bytes_.take(pa.array(take))], names=["place", "point", "vector"])

    return run


def _nearest(keep: int, kind: type):
    """Rows sorted by place (a block's queries, then its points); the nearest points of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, asks = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            place, ids = b.column(0).to_numpy(), b.column(1).to_numpy()
            x = np.frombuffer(b"".join(b.column(2).to_pylist()), kind).reshape(len(ids), -1).astype(np.float64)
            at = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1, [len(place)]])
            for s, e in zip(at, at[1:]):
                if place[s] // 2 != block:
                    if asks is not None:
                        yield asks.found()
                    block, held, asks = place[s] // 2, [], None
                if place[s] % 2 == 0:
                    held.append((ids[s:e], x[s:e]))
                elif held:
                    asks = asks or Asks(np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held]), keep)
                    asks.meet(ids[s:e], x[s:e])
        if asks is not None:
            yield asks.found()

    return run


def measured_window(points: DataFrame, curves: Curves, n: int, k: int, least: int, target: float = TARGET) -> int:
    """The smallest window that brings ``target`` of the probes' exact neighbours into reach on some curve."""
    probes = points.where("asks").orderBy(F.xxhash64("point", F.lit(SEED)), "point").limit(PROBES).select("point", "v").toArrow()
    ids, x = probes.column(0).to_numpy(), _matrix(probes.column(1).combine_chunks())
    rank = F.row_number().over(Window.partitionBy("query").orderBy("score", "point"))
    exact = points.select("point", "v").mapInArrow(_probe(ids, x, k), NEAR).withColumn("r", rank).where(F.col("r") <= k).select("query", "point")
    near = points.select("point", "v").join(F.broadcast(exact), "point").select("query", "point", "v").toArrow()  # k rows a probe
    if not near.num_rows:
        return least
    marked, vectors = np.concatenate([ids, near.column(1).to_numpy()]), np.concatenate([x, _matrix(near.column(2).combine_chunks())])
    marks = [pairs(curves.keys(vectors, c), marked) for c in range(curves.n)]
    order = [np.argsort(m, order=("k", "i"), kind="stable") for m in marks]
    counts = np.zeros((curves.n, len(marked) + 1), np.int64)
    shared = points.select("point", "v").mapInArrow(_counts(curves, [m[o] for m, o in zip(marks, order)]), COUNTS)
    for r in shared.groupBy("curve", "slot").agg(F.sum("n").alias("n")).collect():  # a row per curve and mark
        counts[r["curve"], r["slot"]] = r["n"]
    place = np.empty((curves.n, len(marked)), np.int64)
    for c in range(curves.n):
        place[c][order[c]] = counts[c].cumsum()[:-1]
    asker = {i: j for j, i in enumerate(ids.tolist())}
    of = np.array([asker[q] for q in near.column(0).to_pylist()])
    apart = np.abs(place[:, len(ids):] - place[:, of]).min(0)
    window = least
    while window < n and (apart <= window).mean() < target:
        window = window * 3 // 2
    return window


def boundaries(points: DataFrame, curves: Curves, n: int, blocks: int) -> list[np.ndarray]:
    """The first (key, id) of every block but the first, on each curve, from sampled keys."""
    some = F.pmod(F.xxhash64("point", F.lit(SEED + 1)), F.lit(1 << 30)) < F.lit(int(min(1.0, PER_BLOCK * blocks / n) * (1 << 30)))
    keyed = points.where(some).select("point", "v").mapInArrow(_keys(curves), KEYS)
    # a window over one curve's sample: at most about PER_BLOCK * MAX_BLOCKS rows
    one = Window.partitionBy("curve")
    placed = keyed.withColumns({"r": F.row_number().over(one.orderBy("key", "point")) - 1, "m": F.count("*").over(one)})
    cuts = placed.where((F.col("r") > 0) & (F.floor(F.col("r") * blocks / F.col("m")) > F.floor((F.col("r") - 1) * blocks / F.col("m")))).select("curve", "key", "point").toArrow()
    curve, found = cuts.column(0).to_numpy(), pairs(cuts.column(1).to_numpy(), cuts.column(2).to_numpy())
    return [np.sort(found[curve == c], order=("k", "i")) for c in range(curves.n)]


def search(vectors: DataFrame, asks: Column, k: int = 10, window: int | None = None, curves: int = CURVES,
           least_window: int = LEAST_WINDOW, max_blocks: int = MAX_BLOCKS,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every row where ``asks`` holds.
    ``window`` None: measured."""
    spark = vectors.sparkSession
    fit = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), asks.alias("asks"))
    lengths = fit.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], empty)
    fit = fit.where(F.size("v") == lengths["n"])
    rows = saved(fit.distinct().withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit("second"), "v")}), "vectors")
    # the k + 1 smallest ids of equal vectors are all that a ranking can use
    first = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    few = rows.withColumn("r", first).where(F.col("r") <= k + 1)
    classes = few.groupBy("h1", "h2").agg(F.min("id").alias("point"), F.sort_array(F.collect_list("id")).alias("ids"), F.first("v").alias("v"))
    asking = rows.where("asks").select("h1", "h2").distinct().withColumn("asks", F.lit(True))
    points = saved(classes.join(asking, ["h1", "h2"], "left").withColumn("asks", F.coalesce("asks", F.lit(False))), "points")
    n = points.count()
    if points.where("asks").isEmpty():
        return spark.createDataFrame([], empty)
    draw = F.pmod(F.xxhash64("point", F.lit(SEED)), F.lit(1 << 30))
    some = points.where(draw <= F.lit(int(min(1.0, 1.5 * SAMPLE / n) * (1 << 30))))
    sample = _matrix(some.orderBy(draw, "point").limit(SAMPLE).select("v").toArrow().column(0).combine_chunks())
    fitted = Curves(sample, curves)
    window = window or measured_window(points, fitted, n, k, least_window)
    blocks = min(max_blocks, max(1, round(n / window)))
    kind = np.float32 if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else np.float64
    dealt = points.select("point", "v", "asks").mapInArrow(_deal(fitted, boundaries(points, fitted, n, blocks), blocks, kind), BLOCKS)
    parts = max(1, min(curves * blocks, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    found = dealt.withColumn("block", F.expr("place div 2")).repartition(parts, "block").drop("block").sortWithinPartitions("place").mapInArrow(_nearest(k, kind), NEAR)
    # a pair's score is the same on every curve; the k nearest points hold the k nearest ids, as a point is its smallest id
    best = found.groupBy("query", "point").agg(F.min("score").alias("score"))
    near = best.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy("score", "point"))).where(F.col("r") <= k)
    ranked = near.join(points.select("point", "ids"), "point").select("query", "ids", "score")
    same = points.where("asks").select(F.col("point").alias("query"), "ids", F.lit(0.0).alias("score"))
    listed = saved(ranked.unionByName(same).select("query", F.explode("ids").alias("vec_id"), "score")
                   .withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id")))
                   .where(F.col("r") <= k + 1).groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near")), "listed")
    members = rows.where("asks").join(points.where("asks").select("h1", "h2", F.col("point").alias("query")), ["h1", "h2"]).select(F.col("id").alias("query_id"), "query")
    return (members.join(listed, "query")
            .select("query_id", F.posexplode(F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("rank", "x"))
            .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")))
