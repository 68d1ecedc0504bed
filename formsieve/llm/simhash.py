"""Operator 1: SimHash near-duplicates through vantage-point trees.

Fingerprints: 64 bits over the hashes of word shingles, computed per task.  Equal
fingerprints are one class, so copies never meet in a search.

Trees.  On the full 64-bit metric a vantage point prunes next to nothing at distance 4
(distances crowd around 32 +- 4).  So the search first splits the bits into b blocks: two
fingerprints that differ in at most ``distance`` bits agree on some b - ``distance`` blocks, that
is, their distance under one of the C(b, distance) masks is 0.  Each mask has a tree: a level
branches on the masked Hamming distance to its vantage point, and by the triangle bound
|d(v,x) - d(v,y)| <= d(x,y) = 0 every branch but the fingerprint's own is pruned.  A leaf is a
shard, and a pair within the distance always shares the shard of some tree.  The number
of blocks and levels follows the number of fingerprints, so that shards stay at a few
dozen rows from thousands to 10^11 fingerprints.

Inside a shard a local vantage-point tree on the full metric finds the exact pairs: the
inner side takes the points up to ``distance`` beyond its radius as well (the boundary overlap), and
leaves compare all pairs with a bit count.  A leaf returns each point's component in
it, not its pairs.  Shards of over ``max_shard`` rows (dense clusters of near copies) are not
searched in one task: their rows are dealt into blocks and every pair of blocks is a task.

Components: alternating large-star and small-star steps over the links, saved each
round, until no link changes.

Edge cases: null and empty texts (no words) have fingerprint 0 and are linked like others;
fewer words than a shingle: the whole sequence is the shingle; a null id takes no part in the
smallest id unless its component holds nothing else; rows that share an id each have their row;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_texts, helpers_apart, saved, slices

SHINGLE = 4
DISTANCE = 4
SEED = 42
SHARD_ROWS = 16
MAX_SHARD = 20_000
LEAF = 512


# ------------------------------------------------------------------ fingerprints

def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half of the shingles' hashes."""
    words = (text or b"").lower().split()  # ASCII only: A-Z, [\x20\x09-\x0D]
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - k + 1].tolist()
    ends = ends[k - 1:].tolist()
    n, ones, digest = len(starts), np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, 100_000):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + 100_000], ends[at:at + 100_000])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """(id, fp, the columns ``also``) of every row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in byte_texts(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64), pa.int64()), *b.columns[2:]], names=[id_col, "fp", *also])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("fp", T.LongType()),
                           *(T.StructField(c, docs.schema[c].dataType) for c in also)])
    return docs.select(id_col, text_col, *also).mapInArrow(run, schema)


# ------------------------------------------------------------------ trees

def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_masks(blocks: int, distance: int) -> list[int]:
    """Masks of ``blocks - distance`` of the blocks that the 64 bits are split into."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in itertools.combinations(block, blocks - distance)]


def tree_shape(n: int, distance: int, shard_rows: int = SHARD_ROWS) -> tuple[list[int], list[list[int]]]:
    """(mask, vantage points) of each tree for n fingerprints."""
    blocks = distance + 1
    while blocks < 2 * distance and n > 64 * 2 ** (64 // blocks * (blocks - distance)):
        blocks += 1
    masks = block_masks(blocks, distance)
    bits = 64 // blocks * (blocks - distance)
    # chance that two random points lie equally far from a vantage point
    same = sum(math.comb(bits, d) ** 2 for d in range(bits + 1)) / 4 ** bits
    levels = max(1, min(8, math.ceil(math.log(max(2, n / shard_rows)) / -math.log(same))))
    return masks, [[xxhash.xxh64_intdigest(f"{m}:{j}".encode(), SEED) for j in range(levels)] for m in range(len(masks))]


def shards(fps: DataFrame, n: int, distance: int) -> DataFrame:
    """(shard, fp): the leaf of every fingerprint in every tree."""
    masks, points = tree_shape(n, distance)
    leaves = []
    for t, (mask, vantage) in enumerate(zip(masks, points)):
        path = F.lit(t).cast("long")
        for v in vantage:  # a masked distance of up to 64 takes 7 bits; 8 levels and the tree's number fit a long
            path = F.shiftleft(path, 7).bitwiseOR(F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(v))).bitwiseAND(F.lit(_signed(mask)))))
        leaves.append(path)
    return fps.select("fp", F.explode(F.array(*leaves)).alias("shard"))


# ------------------------------------------------------------------ search inside a shard

def _components(fp: np.ndarray, distance: int) -> np.ndarray:
    """Index of each point's component (its smallest member) among all pairs within the distance."""
    label = np.arange(len(fp))
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= distance
    while True:
        least = np.where(near, label[None, :], len(fp)).min(1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _blocks(fp: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of a set that no vantage point divides, block against block."""
    for i in range(0, len(fp), LEAF):
        for j in range(i, len(fp), LEAF):
            a = np.concatenate([fp[i:i + LEAF], fp[j:j + LEAF]]) if j > i else fp[i:i + LEAF]
            root = _components(a, distance)
            own = root != np.arange(len(a))
            yield a[own], a[root[own]]


def search(fp: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (point, another of its component) that connect all pairs within the distance."""
    todo = [fp]
    while todo:
        part = todo.pop()
        if len(part) <= LEAF:
            root = _components(part, distance)
            own = root != np.arange(len(part))
            yield part[own], part[root[own]]
            continue
        v = part[len(part) // 2]
        d = np.bitwise_count(part ^ v)
        radius = int(np.median(d))
        inner, outer = part[d <= radius + distance], part[d > radius]
        if d.max() <= distance:  # all within reach of the vantage point
            yield part[part != v], np.full(int((part != v).sum()), v)
        elif len(inner) > 0.75 * len(part):  # the bound prunes too little
            yield from _blocks(part, distance)
        else:
            todo += [inner, outer]


def _small(shard: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of many small shards at once: each row against the k-th row after it, while in its shard."""
    a, b, k = [], [], 1
    rows = np.arange(len(fp))
    while len(rows := rows[rows + k < len(fp)]):
        rows = rows[shard[rows] == shard[rows + k]]
        hit = rows[np.bitwise_count(fp[rows] ^ fp[rows + k]) <= distance]
        a.append(fp[hit + k])
        b.append(fp[hit])
        k += 1
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def _links(a: np.ndarray, b: np.ndarray, shard: int | None = None) -> pa.RecordBatch:
    over = pa.nulls(len(a), pa.int64()) if shard is None else pa.array(np.full(len(a), shard), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), over], names=["a", "b", "over"])


SMALL = 48


def _search_sorted(batches: Iterator[pa.RecordBatch], distance: int, max_shard: int | None) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard in; links out, or rows with ``over`` set for shards above ``max_shard``."""
    held_s, held_f = np.empty(0, np.int64), np.empty(0, np.uint64)
    over = None  # the shard that is being passed on

    def solve(s: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]]))
        sizes = np.diff(cuts)
        few = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
        a, b = _small(s[few], f[few], distance)
        if len(a):
            yield _links(a, b)
        for i in np.flatnonzero(sizes > SMALL).tolist():
            for a, b in search(f[cuts[i]:cuts[i + 1]], distance):
                if len(a):
                    yield _links(a, b)

    for batch in batches:
        s, f = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        if over is not None:
            n = int(np.searchsorted(s != over, True)) if len(s) else 0
            if n:
                yield _links(f[:n], f[:n], over)
            s, f = s[n:], f[n:]
            if len(s):
                over = None
        held_s, held_f = np.concatenate([held_s, s]), np.concatenate([held_f, f])
        if not len(held_s):
            continue
        begin = int(np.flatnonzero(held_s == held_s[-1])[0]) if held_s[0] != held_s[-1] else 0
        if begin:
            yield from solve(held_s[:begin], held_f[:begin])
            held_s, held_f = held_s[begin:], held_f[begin:]
        if max_shard is not None and len(held_s) > max_shard:
            over = int(held_s[0])
            yield _links(held_f, held_f, over)
            held_s, held_f = held_s[:0], held_f[:0]
    if len(held_s):
        yield from solve(held_s, held_f)


LINKS = "a long, b long, over long"


def links(fps: DataFrame, distance: int = DISTANCE, max_shard: int = MAX_SHARD) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints within ``distance`` bits (chains included)."""
    n = fps.count()
    found = saved(shards(fps, n, distance).select("shard", "fp").repartition("shard").sortWithinPartitions("shard")
                  .mapInArrow(lambda it: _search_sorted(it, distance, max_shard), LINKS), "links")
    dense = found.where(F.col("over").isNotNull()).select(F.col("over").alias("shard"), F.col("a").alias("fp"))
    near = found.where(F.col("over").isNull()).select("a", "b")
    if not dense.isEmpty():
        sizes = dense.groupBy("shard").agg(F.ceil(2 * F.count("*") / max_shard).alias("g"))
        block = F.pmod(F.xxhash64("fp"), F.col("g"))
        # the planner chooses the join by the measured size of the dense shards' table
        dealt = (dense.join(sizes, "shard").withColumn("i", block)
                 .withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1)))
                 .select(F.xxhash64("shard", F.least("i", "j"), F.greatest("i", "j")).alias("shard"), "fp"))
        more = saved(dealt.repartition("shard").sortWithinPartitions("shard")
                     .mapInArrow(lambda it: _search_sorted(it, distance, None), LINKS), "links")
        near = near.unionByName(more.select("a", "b"))
    return near


# ------------------------------------------------------------------ components

def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in a link; root is the smallest node of its component.

    Star steps: a large step links a node's larger neighbours to its smallest, a small step its smaller ones."""

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star")
    before = state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        e = saved(small.select("x.a", "x.b").where("a <> b").distinct(), "star")
        after = state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def with_roots(classes: DataFrame, distance: int, max_shard: int) -> DataFrame:
    """``classes`` (a row per fp) with the root of each one's component."""
    roots = saved(connected(links(classes.select("fp"), distance, max_shard)), "roots")
    return classes.join(roots, classes["fp"] == roots["node"], "left").drop("node").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, max_shard: int = MAX_SHARD,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) of every row; component_id is the smallest id of its component."""
    marked = saved(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = saved(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "classes")
    rooted = with_roots(classes, distance, max_shard)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # a class of exact copies may hold a third of all rows: its join partition is split by AQE
    names = rooted.join(smallest, "root").select("fp", "component_id")
    return marked.join(names, "fp").select(id_col, "fp", "component_id")


@helpers_apart
def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, max_shard: int = MAX_SHARD,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest id (null last), and among rows
    that share that id the one with the smallest text hash.  Other components' rows of that id stay."""
    cols, key = docs.columns, ["__h1", "__h2"]
    hashed = docs.withColumns({"__h1": F.xxhash64(text_col), "__h2": F.xxhash64(F.lit("second"), text_col)})
    marked = saved(fingerprints(hashed, shingle, id_col, text_col, also=tuple(key)).withColumnRenamed(id_col, "__id"), "fingerprints")
    # minima of minima: a class of exact copies, or all rows without an id, are combined in each task first
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", *key)).alias("first")
    classes = saved(marked.groupBy("fp").agg(first), "classes")
    chosen = with_roots(classes, distance, max_shard).groupBy("root").agg(F.min("first").alias("first"))
    chosen = chosen.select(F.col("first.__id").alias("__i"), F.col("first.__h1").alias("__k1"), F.col("first.__h2").alias("__k2"))
    repeated = marked.groupBy("__id", *key).agg(F.count("*").alias("__n")).where("__n > 1")

    def same(a: DataFrame, b: DataFrame, name: str) -> Column:
        return a[name].eqNullSafe(b["__i"]) & (a["__h1"] == b["__k1"]) & (a["__h2"] == b["__k2"])

    keep = saved(chosen.join(repeated, same(repeated, chosen, "__id"), "left").select("__i", "__k1", "__k2", F.coalesce("__n", F.lit(1)).alias("__n")), "keep")
    kept = hashed.join(keep, same(hashed, keep, id_col))
    if keep.where("__n > 1").isEmpty():
        return kept.select(*cols)
    # rows equal in id and text: one of them, by the hash of all columns that have one
    order = F.xxhash64(*(f.name for f in docs.schema if "map<" not in f.dataType.simpleString()))
    one = kept.where("__n > 1").groupBy("__i", "__k1", "__k2").agg(F.min_by(F.struct(*cols), order).alias("row"))
    return kept.where("__n = 1").select(*cols).unionByName(one.select("row.*"))
