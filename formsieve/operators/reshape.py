"""Unions and reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formsieve.functions.nulls import col, paste

# Most columns a wide merge table may get; more raise instead of being cut.
MAX_WIDE_COLUMNS = 20_000

# Result columns dropped before a merge table is built.
MERGE_DROP = ["X", "se", "min", "max", "repeat.var", "repeat.var.value", "independent.var"]


def union_fill(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns missing from a part are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_onto_template(template: DataFrame, frames: Sequence[DataFrame]) -> DataFrame:
    """The template fixes order and types; its columns come first, the parts' extra
    columns after.  A value that its template type can't hold is null, never an error
    (:func:`formsieve.operators.versions.union_versions` also lists such cells)."""
    from formsieve.operators.versions import fitted
    return fitted([template, *frames], template.schema)


def union_strict(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; the column sets must be equal."""
    first = set(frames[0].columns)
    for f in frames[1:]:
        if set(f.columns) != first:
            raise ValueError(f"columns differ: {sorted(first ^ set(f.columns))}")
    return reduce(lambda a, b: a.unionByName(b), frames)


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """U4: stack result tables."""
    return union_strict(frames)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None,
         var_name: str = "variable", value_name: str = "value", as_text: bool = True) -> DataFrame:
    """Wide -> long.  Mixed value types are made text first."""
    values = list(values) if values is not None else [c for c in df.columns if c not in ids]
    sel = [col(c) for c in ids] + [(col(c).cast("string") if as_text else col(c)).alias(c) for c in values]
    return df.select(*sel).unpivot(list(ids), values, var_name, value_name)


def spread(df: DataFrame, index: Sequence[str], key: str, values: str | Sequence[str],
           keys: Sequence[str]) -> DataFrame:
    """R2: long -> wide with the key list given (no job to discover it).  Cells are
    expected unique; ``first`` picks the value.  Several value columns give
    ``<key>_<value>`` columns."""
    values = [values] if isinstance(values, str) else list(values)
    aggs = [F.first(col(v)).alias(v) for v in values]
    return df.groupBy(*[col(i) for i in index]).pivot(key, list(keys)).agg(*aggs)


def composite_key(*parts, sep: str = ".") -> "Column":
    """``question.option``; a null part prints as ``NA``."""
    return paste(*[col(p) if isinstance(p, str) else p for p in parts], sep=sep)


def to_merge_table(results: DataFrame, keys: Sequence[str] | None = None,
                   index: str = "independent.var.value", check_unique: bool = True) -> DataFrame:
    """Long results -> one row per group, one column per ``variable.value``.

    A cell fed by two result rows would silently keep one of them; with
    ``check_unique`` that is an error (checked on the checkpointed, aggregated results)."""
    r = results.drop(*[c for c in MERGE_DROP if c in results.columns])
    r = r.withColumn("var", composite_key("dependent.var", "dependent.var.value", sep="."))
    if keys is None and check_unique:
        # one job over the checkpointed results gives the keys and the largest number
        # of results per cell of each key
        r = _materialize(r)
        per_key = r.groupBy(col(index), "var").agg(F.count(F.lit(1)).alias("_cells")) \
            .groupBy("var").agg(F.max("_cells").alias("_cells")) \
            .orderBy("var").limit(MAX_WIDE_COLUMNS + 1).collect()
        if len(per_key) > MAX_WIDE_COLUMNS:
            raise ValueError(f"more than {MAX_WIDE_COLUMNS} pivot columns for 'var'")
        dup = [row["var"] for row in per_key if row["_cells"] > 1]
        if dup:
            raise ValueError(f"two results for one merge-table cell: {dup[0]!r}")
        keys = [row["var"] for row in per_key]
    else:
        if keys is None:
            r, keys = pivot_keys(r, "var")
        if check_unique:
            dup = r.groupBy(col(index), "var").count().filter(F.col("count") > 1).limit(1).collect()
            if dup:
                raise ValueError(f"two results for one merge-table cell: {dup[0][0]!r} / {dup[0][1]!r}")
    return spread(r, [index], "var", "numbers", keys)


def _materialize(df: DataFrame) -> DataFrame:
    from formsieve.session import materialize
    return materialize(df)


def pivot_keys(df: DataFrame, key: str, max_keys: int = MAX_WIDE_COLUMNS):
    """The distinct values of a pivot key, read once.  The (aggregated, small) frame is
    checkpointed into the shared checkpoint folder first so the pivot does not recompute
    it; more than ``max_keys`` distinct values is an error, never a silent cut."""
    fixed = _materialize(df)
    keys = [r[0] for r in fixed.select(col(key)).distinct().orderBy(col(key)).limit(max_keys + 1).collect()]
    if len(keys) > max_keys:
        raise ValueError(f"more than {max_keys} pivot columns for {key!r}")
    return fixed, keys


def to_merge_table_confints(results: DataFrame, keys: Sequence[str],
                            rows: Sequence[str] = ("repeat.var", "repeat.var.value"),
                            values: Sequence[str] = ("numbers", "min", "max"),
                            ignore: Sequence[str] = ("se",)) -> DataFrame:
    """key = the remaining columns joined by ``:::``; numbers, min, max pivoted."""
    skip = set(rows) | set(values) | set(ignore)
    key_cols = [c for c in results.columns if c not in skip]
    r = results.withColumn("master_table_column_name", composite_key(*key_cols, sep=":::"))
    return spread(r.select(*[col(c) for c in rows], "master_table_column_name", *[col(v) for v in values]),
                  list(rows), "master_table_column_name", list(values), keys)
