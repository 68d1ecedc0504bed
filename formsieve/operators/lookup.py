"""Code -> label lookups.

``match()`` semantics: the first dictionary row of a code wins and a lookup never
multiplies rows.  The dictionary is reduced to one row per code with ``min_by(label,
ord)`` - a partial aggregate, so a code repeated a million times costs one combine per
task, never a single hot task - and then left-joined.  Join strategy is Catalyst's:
file statistics or AQE's runtime size decide on a broadcast, so nothing is broadcast
without a measured size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formsieve.functions.nulls import col, num_to_text
from formsieve.functions.text import trim_ws

# Largest dictionary turned into one literal map expression; larger ones take the
# unpivot -> join -> pivot path.
MAX_LITERAL_ENTRIES = 100_000


def restrict_list(dictionary: DataFrame, list_name: str) -> DataFrame:
    """The rows of one list (list names compared after trimming)."""
    return dictionary.filter(trim_ws("list_name") == list_name)


def first_per_code(dictionary: DataFrame, key: str = "name", value: str = "label_english",
                   ord_col: str = "ord", scope: Sequence[str] = ()) -> DataFrame:
    """One row per code (per ``scope`` + code): the value of the lowest ``ord``."""
    keys = [col(k) for k in list(scope) + [key]]
    return (dictionary.filter(col(key).isNotNull())
            .groupBy(*keys)
            .agg(F.min_by(col(value), col(ord_col)).alias(value)))


def lookup_first(df: DataFrame, key_col: str, dictionary: DataFrame, out_col: str,
                 dict_key: str = "name", dict_value: str = "label_english", ord_col: str = "ord",
                 list_name: str | None = None, key_expr: Column | None = None) -> DataFrame:
    """Add ``out_col`` = first-matching label of ``df[key_col]`` (null when unmatched).

    The join strategy is the planner's: a broadcast only when file statistics or AQE's
    runtime size of the reduced dictionary are under the threshold, else a shuffle join."""
    d = restrict_list(dictionary, list_name) if list_name is not None else dictionary
    d = first_per_code(d, dict_key, dict_value, ord_col)
    d = d.select(col(dict_key).alias("_lk_key"), col(dict_value).alias(out_col))
    k = key_expr if key_expr is not None else col(key_col).cast("string")
    left = df.withColumn("_lk_src", k)
    return left.join(d, left["_lk_src"] == d["_lk_key"], "left").drop("_lk_src", "_lk_key")


def literal_map(pairs: Mapping[str, str] | Sequence[tuple]) -> Column:
    """A literal ``MapType`` column from python pairs (bounded, metadata sized)."""
    items = pairs.items() if isinstance(pairs, Mapping) else pairs
    flat = []
    for k, v in items:
        flat += [F.lit(k), F.lit(v)]
    return F.create_map(*flat) if flat else F.create_map().cast("map<string,string>")


# Dictionaries up to this size stay one flat map; larger ones are split into hash
# buckets (a map of small maps), because a map lookup scans its keys one by one.
FLAT_MAP_ENTRIES = 32


def dictionary_map(dictionary: DataFrame, key: str = "name", value: str = "label_english",
                   ord_col: str = "ord", max_entries: int = MAX_LITERAL_ENTRIES) -> Column | None:
    """The first-match dictionary as one flat literal map, or ``None`` when it is larger
    than ``max_entries``.  One bounded job: at most ``max_entries + 1`` rows reach the
    driver."""
    pairs = _dictionary_pairs(dictionary, key, value, ord_col, max_entries)
    return None if pairs is None else literal_map(pairs)


def _dictionary_pairs(dictionary, key, value, ord_col, max_entries):
    d = first_per_code(dictionary, key, value, ord_col)
    rows = d.select(col(key).cast("string"), col(value).cast("string")).limit(max_entries + 1).collect()
    return None if len(rows) > max_entries else [(r[0], r[1]) for r in rows]


def dictionary_lookup(dictionary: DataFrame, key: str = "name", value: str = "label_english",
                      ord_col: str = "ord", max_entries: int = MAX_LITERAL_ENTRIES):
    """A function ``text column -> label column`` over the first-match dictionary, as
    literal expressions (no join), or ``None`` when the dictionary exceeds
    ``max_entries``.

    Spark finds a key in a map by scanning its keys, so a large dictionary is split into
    about sqrt(n) buckets by ``xxhash64`` of the code: a lookup scans one bucket list and
    one small map, ~2*sqrt(n) comparisons instead of n.  Bucket ids are computed by
    Spark's own hash, on the collected pairs, so driver and executors agree."""
    pairs = _dictionary_pairs(dictionary, key, value, ord_col, max_entries)
    return None if pairs is None else _lookup_of(dictionary, pairs)


def _lookup_of(dictionary: DataFrame, pairs: list[tuple]):
    if len(pairs) <= FLAT_MAP_ENTRIES:
        flat = literal_map(pairs)
        return lambda text: F.try_element_at(flat, text)
    n_buckets = max(2, int(round(len(pairs) ** 0.5)))
    spark = dictionary.sparkSession
    tagged = spark.createDataFrame(pairs, "k string, v string") \
        .select("k", "v", F.pmod(F.xxhash64("k"), F.lit(n_buckets)).alias("b")).collect()
    buckets: dict[int, list] = {}
    for r in tagged:
        buckets.setdefault(int(r["b"]), []).append((r["k"], r["v"]))
    nested = F.create_map(*[x for b, kv in sorted(buckets.items()) for x in (F.lit(b), literal_map(kv))])

    def lookup(text: Column) -> Column:
        return F.try_element_at(F.try_element_at(nested, F.pmod(F.xxhash64(text), F.lit(n_buckets))), text)
    return lookup


def _cell_text(df: DataFrame, c: str) -> Column:
    return num_to_text(c, df.schema[c].dataType)


def occurring_pairs(df: DataFrame, cols: Sequence[str], dictionary: DataFrame, key: str = "name", value: str = "label_english",
                    ord_col: str = "ord", max_entries: int = MAX_LITERAL_ENTRIES) -> list[tuple] | None:
    """The first-match dictionary of the codes that occur in ``cols``, or ``None`` if they are more than ``max_entries``.

    One aggregate over the cells: each task hands on its distinct codes, not its rows."""
    codes = df.select(F.explode(F.array(*[_cell_text(df, c) for c in cols])).alias("_code")).filter(F.col("_code").isNotNull()).distinct()
    d = first_per_code(dictionary, key, value, ord_col).select(col(key).cast("string").alias("_code"), col(value).cast("string").alias("_label"))
    rows = d.join(codes, "_code", "left_semi").limit(max_entries + 1).collect()
    return None if len(rows) > max_entries else [(r[0], r[1]) for r in rows]


def label_columns(df: DataFrame, cols: Sequence[str], dictionary: DataFrame,
                  key: str = "name", value: str = "label_english", ord_col: str = "ord",
                  max_entries: int = MAX_LITERAL_ENTRIES, id_col: str | None = None,
                  keep_unmatched: bool = False) -> DataFrame:
    """Every cell of ``cols`` replaced by its first-match label; unmatched -> null
    (or, with ``keep_unmatched``, the cell's own text).

    Bounded dictionary: literal (hash-bucketed) maps, one lookup per column, all inside
    the scan's codegen stage (no join).  Larger dictionary: the codes that occur are found
    first (:func:`occurring_pairs`) and only they become the maps, so the frame itself is
    neither unpivoted nor shuffled.  Only if more than ``max_entries`` dictionary codes occur: unpivot -> one join ->
    pivot back (``label_columns_join``).  ``id_col`` is accepted for compatibility; the
    join path numbers rows itself, so duplicated ids cannot mix labels."""
    lookup = dictionary_lookup(dictionary, key, value, ord_col, max_entries)
    if lookup is None:
        pairs = occurring_pairs(df, cols, dictionary, key, value, ord_col, max_entries)
        lookup = None if pairs is None else _lookup_of(dictionary, pairs)
    if lookup is None:
        return label_columns_join(df, cols, dictionary, key, value, ord_col, keep_unmatched)

    def label(c):
        text = _cell_text(df, c)
        hit = lookup(text)
        return F.coalesce(hit, text) if keep_unmatched else hit
    return df.withColumns({c: label(c) for c in cols})


def label_columns_join(df: DataFrame, cols: Sequence[str], dictionary: DataFrame,
                       key: str = "name", value: str = "label_english", ord_col: str = "ord",
                       keep_unmatched: bool = False) -> DataFrame:
    """J2, join path for dictionaries too large for a literal map.

    Rows get an id that a reliable checkpoint fixes across retries; the coded cells
    are unpivoted, joined once with the reduced dictionary (AQE splits a hot code) and
    pivoted back with the known column list, then joined to the rest of the row."""
    from formsieve.session import materialize
    rid = "_fs_rid"
    base = materialize(df.withColumn(rid, F.monotonically_increasing_id()))
    d = first_per_code(dictionary, key, value, ord_col).select(
        col(key).cast("string").alias("_code"), col(value).alias("_label"))
    long = base.select(F.col(rid), *[_cell_text(df, c).alias(c) for c in cols]) \
        .unpivot([rid], list(cols), "_var", "_code")
    labelled = long.join(d, "_code", "left")
    cell = F.coalesce(F.col("_label"), F.col("_code")) if keep_unmatched else F.col("_label")
    wide = labelled.groupBy(F.col(rid)).pivot("_var", list(cols)).agg(F.first(cell))
    out = base.drop(*cols).join(wide, rid, "left")
    return out.select(*[col(c) for c in df.columns])


def map_values(df: DataFrame, cols: Sequence[str], mapping: Mapping[str, str]) -> DataFrame:
    """A small inline table (e.g. status -> icon path) applied to a column range."""
    m = literal_map(mapping)
    return df.withColumns({c: F.try_element_at(m, _cell_text(df, c)) for c in cols})


def lookup_by_trimmed_name(df: DataFrame, name_col: str, master: DataFrame, out_col: str,
                           master_name: str = "site_name", master_code: str = "site_code",
                           ord_col: str | None = None) -> DataFrame:
    """Master code by trimmed name, first match."""
    m = master.select(trim_ws(master_name).alias("name"), col(master_code).alias("label_english"),
                      (col(ord_col) if ord_col else F.monotonically_increasing_id()).alias("ord"))
    return lookup_first(df, name_col, m, out_col, key_expr=trim_ws(name_col))


def label_or_text(label: str, free_text: str) -> Column:
    """The label when present, else the free text."""
    return F.coalesce(col(label).cast("string"), col(free_text).cast("string"))


def override_code(master: str, own: str) -> Column:
    """E5: master code when present, else the own code."""
    return F.coalesce(col(master), col(own))


def recode_value(c, old: str, new: str) -> Column:
    """One legacy value to its new code; null stays null."""
    c = col(c)
    return F.when(c == old, F.lit(new)).when(c != old, c)
