"""Operator 11: the prefix trie of conversations, built by the van Emde Boas recursion.

A sequence of turns is cut at half depth.  The upper half is named (a digest of the names of its
root and its turns), equal upper halves under one root become one row with their members counted, and the
lower halves go on under the name of the cut.  Upper trie and lower forests are rows of the same table, so one
shuffle per level halves them all at once; after ``log2(depth)`` levels a row is a node.

Totals come back without going down the trie again.  A depth ``d`` is cut at one level only, the one whose half
height is the lowest set bit of ``d``.  A node lies in the lower forest of some cut nodes (at most
one per level): each cut node sums the values of its lower forest, and that sum is grafted on the
nodes of its path in the upper trie.  Every descendant is thus added to every ancestor exactly once.

Sequences of over ``chunk`` turns are rows of ``chunk`` turns each; the chunks' digests are sequences
in turn, ``chunk`` times shorter, that are named and summed by the same functions.  So no
row and no group holds a whole conversation.  Texts are read once and only their digests
(MD5 of role and text, 128 bits) and lengths are shuffled.

The digest of a node's ends is a chain over all their ids; ids are sorted and joined to texts by ranges
of ids, and the pieces (up to thousands of ids each) are streamed through SHA-256.

Edge cases: null role or text is empty; a null turn comes first; turns of equal number go by digest, repeated
rows stay repeated turns; rows with a null conversation id (or one that is no integer) take no part; conversations
left without turns are members of the root; an empty table has no root, so no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

CHUNK = 1024
GROUP = 100
MOST_SHARED = 6
#: Ids of one piece of a node's ends are of one range of so many.
SPAN = 4096
#: Name of the root, and hex digits of a digest; a turn's symbol has 8 more for its length.
ROOT = hashlib.md5(b"", usedforsecurity=False).hexdigest()
DIGITS = 32
SYMBOL = DIGITS + 8


def name(root: Column, part: Column) -> Column:
    return F.md5(F.concat(root, part))


def path_names(root: str, part: str, size: int) -> list[str]:
    """Names of the nodes along ``part``, whose symbols have ``size`` digits: a depth is named
    from the cut before it, its lowest set bit away."""
    names = [root]
    for j in range(1, len(part) // size + 1):
        cut = j - (j & -j)
        names.append(hashlib.md5((names[cut] + part[cut * size:j * size]).encode(), usedforsecurity=False).hexdigest())
    return names[1:]


# ------------------------------------------------------------------ sequences

def turns(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, sym): every turn's number and symbol."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return conversations.select(F.col(id_col).try_cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                                F.concat(digest, F.lpad(F.hex(F.length(text)), SYMBOL - DIGITS, "0")).alias("sym")).filter("conv IS NOT NULL")


#: Kinds of rows of a conversation, in their order: one mark, the group's turns, its own.
MARK, SHARED, OWN = 0, 1, 2


def shared_turns(rows: DataFrame) -> DataFrame:
    """(conv, kind, place, sym): a mark for every conversation and the turns it takes from its group's first."""
    # row_number() <= n: a task hands on n rows of a conversation at most
    place = F.row_number().over(Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "sym"))
    heads = rows.filter(F.col("conv") % GROUP == 0).withColumn("place", place).filter(F.col("place") < MOST_SHARED) \
        .groupBy(F.col("conv").alias("base")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "sym"))), lambda x: x.sym).alias("head"))
    convs = rows.select("conv").distinct().withColumn("base", F.col("conv") - F.col("conv") % GROUP)
    took = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), own_turns_replaced())
    return convs.join(heads, "base", "left").select("conv", F.posexplode(F.concat(F.array(F.lit("")), took)).alias("place", "sym")) \
        .select("conv", F.when(F.col("place") == 0, MARK).otherwise(SHARED).alias("kind"), "place", "sym")


def own_turns_replaced() -> Column:
    return (F.crc32(F.col("conv").cast("string").cast("binary")) % MOST_SHARED).cast("int")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the rows (conv, kind, sym) of a sorted partition within each conversation and kind.

    Rows of negative kind tell how many rows of its first and last conversation the partition holds."""
    part = TaskContext.get().partitionId()
    columns = ["conv", "kind", "at", "shared", "sym", "part"]

    def out(conv, kind, at, shared, sym):
        return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(kind, pa.int32()), pa.array(at, pa.int64()),
                                           pa.array(shared, pa.int64()), sym, pa.array(np.full(len(conv), part, np.int32))], names=columns)

    first, conv, counts, first_counts = None, None, [0, 0, 0], None
    for b in batches:
        if not b.num_rows:
            continue
        convs, kinds = b.column(0).to_numpy(), b.column(1).to_numpy()
        n = len(convs)
        new = np.flatnonzero(np.concatenate([[True], (convs[1:] != convs[:-1]) | (kinds[1:] != kinds[:-1])]))
        at, shared = np.arange(1, n + 1), np.zeros(n, np.int64)
        for s, e in zip(new.tolist(), [*new[1:].tolist(), n]):
            if convs[s] != conv:
                if first is not None and first_counts is None:
                    first_counts = counts
                conv, counts = int(convs[s]), [0, 0, 0]
                first = conv if first is None else first
            at[s:e] += counts[kinds[s]] - s
            shared[s:e] = counts[SHARED]
            counts[kinds[s]] += e - s
        yield out(convs, kinds, at, shared, b.column(2))
    if first is not None:
        ends = [(first, first_counts or counts)] + ([(conv, counts)] if first_counts else [])
        yield out([c for c, _ in ends for _ in (0, 1)], [-SHARED, -OWN] * len(ends), [n for _, c in ends for n in c[1:]],
                  [0, 0] * len(ends), pa.array([""] * 2 * len(ends), pa.string()))


def rebuilt(rows: DataFrame) -> DataFrame:
    """(conv, pos, sym): the rebuilt conversations' turns from 1, and a mark (pos 0) for every conversation.

    One conversation may hold a third of all turns, so places come from a total order dealt to range partitions, and
    a conversation that goes on from one partition to the next takes its counts along (at most
    two rows a partition)."""
    both = shared_turns(rows).select("conv", "kind", "place", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), "sym") \
        .unionByName(rows.select("conv", F.lit(OWN).alias("kind"), F.lit(0).alias("place"), "turn", "sym"))
    order = [F.col("conv"), F.col("kind"), F.col("place"), F.col("turn").asc_nulls_first(), F.col("sym")]
    placed = saved(both.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "kind", "sym")
                   .mapInArrow(_counted, "conv long, kind int, at long, shared long, sym string, part int"), "trie_places")
    so_far: dict[int, list[int]] = {}
    carried = []
    ends = defaultdict(dict)
    for r in placed.filter("kind < 0").collect():  # four rows a partition at most
        ends[r["part"], r["conv"]][-r["kind"]] = r["at"]
    for (part, conv), n in sorted(ends.items()):
        before = so_far.get(conv, [0, 0])
        if any(before):
            carried.append((part, conv, *before))
        so_far = {conv: [before[0] + n[SHARED], before[1] + n[OWN]]}
    carry = F.broadcast(rows.sparkSession.createDataFrame(carried, "part int, conv long, more_shared long, more_own long"))
    j = placed.filter("kind >= 0").join(carry, ["part", "conv"], "left")
    h, shared, own = own_turns_replaced(), F.coalesce("more_shared", F.lit(0)), F.coalesce("more_own", F.lit(0))
    at = F.col("at") + own
    return j.filter((F.col("kind") != OWN) | (at > h)).select("conv", F.when(F.col("kind") == MARK, 0).when(F.col("kind") == SHARED, F.col("at") + shared)
                                                              .otherwise(at - h + F.col("shared") + shared).alias("pos"), "sym")


def chunked(rows: DataFrame, chunk: int) -> DataFrame:
    """(conv, chunk, seq): the symbols of up to ``chunk`` turns (conv, pos, sym) in one text; a mark has none."""
    at = F.expr(f"(greatest(pos, 1) - 1) div {chunk}")
    return rows.groupBy("conv", at.alias("chunk")) \
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "sym"))), lambda x: x.sym), "").alias("seq"))


# ------------------------------------------------------------------ one height of chunks

class Height:
    """Sequences cut into chunks at one height: their nodes, their cuts, and the height above (chunks as symbols)."""

    def __init__(self, rows: DataFrame, size: int, chunk: int):
        """``rows``: (conv, chunk, seq), saved."""
        self.size, self.chunk = size, chunk
        longest = (rows.agg(F.max(F.length("seq"))).first()[0] or 0) // size
        self.above = None
        if longest < chunk:
            self.rows = rows.withColumns({"root": F.lit(ROOT), "end": F.lit(None).cast("string")})
        else:
            full = rows.filter(F.length("seq") == size * chunk)
            digests = full.select("conv", (F.col("chunk") + 1).alias("pos"), F.md5("seq").alias("sym"))
            self.above = Height(saved(chunked(digests, chunk), "trie_chunks"), DIGITS, chunk)
            ends = self.above.names()
            starts = ends.select("conv", (F.col("chunk") + 1).alias("chunk"), F.col("end").alias("root"))
            self.rows = saved(rows.join(starts, ["conv", "chunk"], "left").join(ends, ["conv", "chunk"], "left")
                              .withColumn("root", F.coalesce("root", F.lit(ROOT))), "trie_rows")
        self._split(longest)

    def names(self) -> DataFrame:
        """(conv, chunk, end): the name of each full chunk below, from this height's sequences."""
        size, chunk = self.size, self.chunk

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in b.to_pylist():
                    ends = path_names(r["root"], r["seq"], size)
                    if r["end"] is not None:
                        ends[-1] = r["end"]
                    yield pa.RecordBatch.from_pydict({"conv": pa.array([r["conv"]] * len(ends), pa.int64()), "end": ends,
                                                      "chunk": pa.array(range(r["chunk"] * chunk, r["chunk"] * chunk + len(ends)), pa.int64())})

        return self.rows.select("conv", "chunk", "seq", "root", "end").mapInArrow(run, "conv long, end string, chunk long")

    def last(self) -> DataFrame:
        """(conv, whole): the key of the row that holds each conversation's last turn (the root's name if it has none)."""
        rows = self.rows.select("conv", "chunk", F.when(F.length("seq") == 0, F.lit(ROOT)).otherwise(name(F.col("root"), F.col("seq"))).alias("whole"))
        if self.above is None:  # one chunk each
            return rows.select("conv", "whole")
        return rows.groupBy("conv").agg(F.max_by("whole", "chunk").alias("whole"))

    def _split(self, longest: int) -> None:
        size, rows = self.size, self.rows.filter(F.length("seq") > 0)
        # lowers: the cut nodes whose lower forest a row lies in, but for whole chunks; whole: the key of the sequences that end with the row
        block = rows.groupBy("root", "seq").agg(
            F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.max("end").alias("end"), F.max(F.col("chunk") * self.chunk).alias("start"))
        block = block.withColumns({"whole": name(F.col("root"), F.col("seq")), "top": F.col("root"), "lowers": F.array().cast("array<string>")})
        self.cuts = []
        if self.above is not None:  # a whole chunk's own path, for what hangs below its end
            block = saved(block, "trie_block")
            self.cuts.append(block.filter(F.col("end").isNotNull()).select("end", "root", "seq"))
        half = 1
        while 2 * half <= longest and 2 * half < self.chunk:
            half *= 2
        while half >= 1:
            block = saved(self._halved(block, half), f"trie_{half}")
            self.cuts.append(block.filter((F.length("seq") == half * size) & (F.col("start") % (2 * half) == 0)).select("end", "root", "seq"))
            half //= 2
        self.nodes = block

    def _halved(self, block: DataFrame, half: int) -> DataFrame:
        """Every row's upper half, and its lower half under the upper's name; equal rows are one."""
        size, seq, root = self.size, F.col("seq"), F.col("root")
        upper, lower = F.substring(seq, 1, half * size), F.substring(seq, half * size + 1, half * size)
        cut = name(root, upper)
        longer = F.length(seq) > half * size
        row = lambda **c: F.struct(*[v.alias(k) for k, v in c.items()], F.col("n"), F.col("conv"), F.col("top"))
        none = F.lit(None).cast("string")
        up = row(root=root, seq=upper, whole=F.when(longer, none).otherwise(F.col("whole")),
                 end=F.when(F.length(seq) >= half * size, cut).otherwise(F.col("end")), start=F.col("start"), lowers=F.col("lowers"))
        low = row(root=cut, seq=lower, whole=F.col("whole"), end=F.col("end"), start=F.col("start") + half, lowers=F.concat("lowers", F.array(cut)))
        parts = block.select(F.explode(F.when(longer, F.array(up, low)).otherwise(F.array(up))).alias("x")).select("x.*")
        # start, top and lowers follow from the root
        return parts.groupBy("root", "seq").agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), F.max("whole").alias("whole"), F.max("end").alias("end"),
                                                F.first("start").alias("start"), F.first("top").alias("top"), F.first("lowers").alias("lowers"))

    def totals(self, own: DataFrame) -> DataFrame:
        """(name, leaves, saved) summed over subtrees; ``own`` holds the nodes with their own (name, top, lowers, leaves, saved)."""
        sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
        below = own.select(F.explode("lowers").alias("end"), "leaves", "saved").groupBy("end").agg(*sums)
        if self.above is not None:
            # all below a whole chunk: its own forest of chunks, and the forests below that
            forest = own.filter(F.col("top") != ROOT).groupBy(F.col("top").alias("name")).agg(*sums)
            chunks = self.above.nodes.select(F.col("end").alias("name"), "top", "lowers").join(forest, "name")
            below = below.unionByName(self.above.totals(chunks).withColumnRenamed("name", "end"))
        paths = reduce(DataFrame.unionByName, self.cuts).join(below, "end")
        size = self.size

        def graft(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in b.to_pylist():
                    names = path_names(r["root"], r["seq"], size)[:-1] + [r["end"]]
                    yield pa.RecordBatch.from_pydict({"name": names, "leaves": pa.array([r["leaves"]] * len(names), pa.int64()),
                                                      "saved": pa.array([r["saved"]] * len(names), pa.int64())})

        grafted = paths.select("end", "root", "seq", "leaves", "saved").mapInArrow(graft, "name string, leaves long, saved long")
        return own.select("name", "leaves", "saved").unionByName(grafted).groupBy("name").agg(*sums)


# ------------------------------------------------------------------ ends

def id_digests(ends: DataFrame) -> DataFrame:
    """(whole, ends_sha256): SHA-256 of the ascending ids of each key, comma-joined.

    Ids of one key may be a third of all: they are joined to texts by ranges of ``SPAN`` consecutive ids, and only those
    texts are streamed, in order, through the key's hash in one task."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for b in batches:
            done = []
            for at, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if at == key:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = at, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_pydict({"whole": [x[0] for x in done], "ends_sha256": [x[1] for x in done]})
        if state is not None:
            yield pa.RecordBatch.from_pydict({"whole": [key], "ends_sha256": [state.hexdigest()]})

    span = F.floor(F.col("conv") / SPAN)
    pieces = ends.groupBy("whole", span.alias("span")).agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))
    return pieces.repartition("whole").sortWithinPartitions("whole", "span").mapInArrow(hashed, "whole string, ends_sha256 string")


# ------------------------------------------------------------------ the trie

def build(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
          chunk: int = CHUNK) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    ``chunk`` is a power of two."""
    sequences = saved(chunked(rebuilt(saved(turns(conversations, id_col, turn_col, role_col, text_col), "trie_turns")), chunk), "trie_sequences")
    trie = Height(sequences, SYMBOL, chunk)
    none = F.lit(None).cast("string")
    root = sequences.filter("chunk = 0").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).filter("n > 0") \
        .select(F.lit(ROOT).alias("end"), none.alias("root"), F.lit(0).cast("long").alias("depth"), "n", "conv", F.lit(0).cast("long").alias("chars"),
                F.lit(ROOT).alias("whole"), none.alias("top"), F.array().cast("array<string>").alias("lowers"))
    chars = F.conv(F.substring("seq", DIGITS + 1, SYMBOL - DIGITS), 16, 10).cast("long")
    below = trie.nodes.select("end", "root", (F.col("start") + 1).cast("long").alias("depth"), "n", "conv", chars.alias("chars"), "whole", "top", "lowers")
    children = below.groupBy(F.col("root").alias("end")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = below.unionByName(root).join(children, "end", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = saved(nodes.withColumns({"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n") - 1) * F.col("chars")}), "trie_nodes")
    own = nodes.withColumnRenamed("end", "name")
    # the root is on no path: it gets the sum of all
    all_of_it = own.agg(F.lit(ROOT).alias("name"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    totals = trie.totals(own.filter(F.col("name") != ROOT).select("name", "top", "lowers", "leaves", "saved")).unionByName(all_of_it)
    parents = nodes.select(F.col("end").alias("root"), F.col("conv").alias("parent"))
    empty = hashlib.sha256(b"").hexdigest()
    return nodes.drop("leaves", "saved").join(totals.withColumnRenamed("name", "end"), "end").join(parents, "root", "left") \
        .join(id_digests(trie.last()), "whole", "left") \
        .select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
                F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))
