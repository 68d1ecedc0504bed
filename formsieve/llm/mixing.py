"""Operator 8: mixing sources to target weights by pivotal dependent rounding, native.

Targets.  Source weights repeat a cycle in code-point order (null last).  Sources share
``share`` of all words by weight; a target stops at ``cap`` times its source's words and
the excess is reshared.  That is one water level: with sources in ascending order of
cap / weight, the level of a source is (words still to share) / (weights still open), and
a source is capped while its own ratio is below it.  It takes one window over the
sources' totals - one row per source.

Rounding.  A document of ``w`` words from a source with c = target / words is taken
floor(c) times, and once more with probability p = c - floor(c).  These p are
rounded by size-weighted pivotal steps: two documents a and b with fractional p pass mass
between them so that w_a p_a + w_b p_b stays, until one of the two is 0 or 1; the
direction is drawn so that each p keeps its expectation.  So a source's taken words stay
at its target but for the one document left at the end.

A reduction tree runs the steps: documents are dealt by hash into blocks of about
``block`` per source (so a source with a third of all rows is many blocks), each block is
one fold of ``aggregate`` over its sorted documents, and its one residual document goes up
to the next level, until each source is one block; its last residual is rounded to
the nearer integer, which keeps the error at most half of that document.

All random draws are hashes of (document, partner, level, seed), so reruns agree.  Only DataFrame
functions are used.

Edge cases: a null or empty text has size 0, and is taken 0 words and once if its source is
taken at all (floor(c) copies at least); a null source is a source of its own, last; rows that share
an id are separate documents; an empty table gives an empty result; a source without words
has target 0; extra columns are not read by ``plan_mix`` and are kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import helpers_apart, saved, SPACE, strip_space

WEIGHTS = (3, 1, 2)
BLOCK = 128


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null: 0."""
    one = strip_space(F.translate(text, SPACE, " " * len(SPACE)))
    bare = F.regexp_replace(one, " {2,}", " ")
    return F.coalesce(F.when(F.length(bare) > 0, F.length(bare) - F.length(F.replace(bare, F.lit(" "), F.lit(""))) + 1), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target), a row per source, from rows (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    every = Window.orderBy("ratio", "place")
    rest = every.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    done = every.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (totals.withColumn("place", place).withColumn("weight", F.get(cycle, (F.col("place") % len(weights)).cast("int")))
            .withColumn("limit", F.col("source_size") * F.lit(cap)).withColumn("ratio", F.col("limit") / F.col("weight"))
            .withColumn("level", (F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("limit").over(done), F.lit(0.0)))
                        / F.sum("weight").over(rest))
            # the level of the first source that isn't capped holds for all after it; it is the
            # highest of the uncapped, as each of them takes less than its limit
            .withColumn("water", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(whole))
            .select("source", "source_size",
                    F.when(F.col("ratio") <= F.coalesce("water", F.col("ratio")), F.col("limit"))
                    .otherwise(F.col("weight") * F.col("water")).alias("target")))


#: One pivotal step of the fold: ``acc.cur`` meets ``x``.  Fields: k (document's hash), w (size), p (probability), and
#: ``row``.  ``up`` is the mass that moves if cur rises, ``down`` if cur falls; cur rises with probability down / (up + down).
_FOLD = """
aggregate(items, named_struct('out', slice(items, 1, 0), 'cur', items[0]),
  (acc, x) -> CASE WHEN x.k = items[0].k AND x.n = items[0].n THEN acc
    WHEN acc.cur.p <= 0 OR acc.cur.p >= 1 THEN named_struct('out', concat(acc.out, array(acc.cur)), 'cur', x)
    WHEN x.p <= 0 OR x.p >= 1 THEN named_struct('out', concat(acc.out, array(x)), 'cur', acc.cur)
    ELSE {pivot} END)
"""


def _pivot(level: int, seed: int) -> str:
    a, b = "acc.cur", "x"
    up = f"least((1 - {a}.p) * {a}.w, {b}.p * {b}.w)"
    down = f"least({a}.p * {a}.w, (1 - {b}.p) * {b}.w)"
    draw = f"((xxhash64({a}.k, {a}.n, {b}.k, {b}.n, {level}, {seed}) & 9007199254740991) / 9007199254740992D)"
    rises = f"({draw} * ({up} + {down}) < {down})"

    def moved(who: str, is_a: bool) -> str:
        """p after the step: exactly 0 or 1 where this document is the one that ends."""
        other = b if is_a else a
        gain = f"CASE WHEN (1 - {who}.p) * {who}.w <= {other}.p * {other}.w THEN 1D ELSE {who}.p + {other}.p * {other}.w / {who}.w END"
        loss = f"CASE WHEN {who}.p * {who}.w <= (1 - {other}.p) * {other}.w THEN 0D ELSE {who}.p - (1 - {other}.p) * {other}.w / {who}.w END"
        return f"(CASE WHEN {rises if is_a else f'NOT {rises}'} THEN {gain} ELSE {loss} END)"

    def struct(who: str, is_a: bool) -> str:
        return f"named_struct('k', {who}.k, 'n', {who}.n, 'w', {who}.w, 'p', {moved(who, is_a)}, 'row', {who}.row)"

    new_a, new_b = struct(a, True), struct(b, False)
    ended = f"({moved(a, True)} <= 0 OR {moved(a, True)} >= 1)"
    return (f"CASE WHEN {ended} THEN named_struct('out', concat(acc.out, array({new_a})), 'cur', {new_b}) "
            f"ELSE named_struct('out', concat(acc.out, array({new_b})), 'cur', {new_a}) END")


def plan_mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, block: int = BLOCK, seed: int = 8,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, copies), a row per document."""
    sized = saved(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"),
                              F.xxhash64(F.col(id_col).cast("string"), F.xxhash64(text_col), F.lit(seed)).alias("k")), "sizes")
    targets = source_targets(sized, weights, share, cap)
    targets = saved(targets.withColumn("c", F.coalesce(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size")), F.lit(0.0))), "targets")
    n_rows = sized.groupBy("source").count()
    info = targets.join(n_rows, targets["source"].eqNullSafe(n_rows["source"])).select(targets["source"].alias("s"), "source_size", "target", "c", "count")
    # a row per source: broadcast only if the session's threshold admits its measured size
    rows = sized.join(info, sized["source"].eqNullSafe(info["s"])).drop("s")
    base = F.least(F.floor("c"), F.lit(int(cap)))
    items = rows.select(
        "source", F.ceil(F.col("count") / block).alias("blocks"),
        F.struct(F.col("k"), F.lit(0).alias("n"), F.greatest(F.col("size"), F.lit(0)).cast("double").alias("w"),
                 # documents without words carry no mass: they take no part in the rounding
                 F.when(F.col("size") > 0, F.col("c") - base).otherwise(F.lit(0.0)).alias("p"),
                 F.struct("id", "size", "source_size", "target", base.cast("int").alias("base")).alias("row")).alias("item"))

    largest = n_rows.agg(F.max("count")).first()[0] or 0
    finished, level = [], 0
    while True:
        last = largest <= block
        dealt = items.groupBy("source", F.when(F.lit(last), F.lit(0)).otherwise(
            F.pmod(F.xxhash64("item.k", F.lit(level)), F.col("blocks"))).alias("block"), "blocks")
        # equal rows (same id and text) get the same k; n tells them apart inside a block
        ordered = F.expr("transform(array_sort(collect_list(item)), (x, i) -> named_struct('k', x.k, 'n', i, 'w', x.w, 'p', x.p, 'row', x.row))")
        folded = saved(dealt.agg(ordered.alias("items")).select("source", "blocks", F.expr(_FOLD.format(pivot=_pivot(level, seed))).alias("f")), "level")
        finished.append(folded.select(F.inline("f.out")))
        if last:
            finished.append(folded.select("f.cur.*"))
            break
        largest = -(-largest // block)
        items = folded.select("source", F.ceil(F.col("blocks") / block).alias("blocks"), F.col("f.cur").alias("item"))
        level += 1
    out = finished[0]
    for x in finished[1:]:
        out = out.unionByName(x)
    # p is 0 or 1 but for a source's last residual, which goes to the nearer one
    return out.select(F.col("row.id").alias(id_col), F.col("row.size").alias("size"), F.col("row.source_size").alias("source_size"),
                      F.col("row.target").alias("target"), (F.col("row.base") + F.when(F.col("p") >= 0.5, 1).otherwise(0)).alias("copies"))


@helpers_apart
def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; rows that share an id get
    their copies in the order of their text's hash."""
    cols = docs.columns
    taken = plan_mix(docs, id_col=id_col, text_col=text_col, **options)
    counts = saved(taken.groupBy(F.col(id_col).alias("__id")).agg(F.sort_array(F.collect_list("copies"), asc=False).alias("__copies")), "copies")
    keyed = docs.join(counts, docs[id_col].eqNullSafe(counts["__id"]))
    if counts.where(F.size("__copies") > 1).isEmpty():
        n = F.get("__copies", F.lit(0))
    else:
        rank = F.row_number().over(Window.partitionBy(id_col).orderBy(F.xxhash64(text_col)))
        keyed, n = keyed.withColumn("__rank", rank), F.get("__copies", F.col("__rank") - 1)
    return keyed.withColumn("__n", n).where(F.col("__n") > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*cols)
