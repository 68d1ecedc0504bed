"""Applying an edited correction log.

The log is reduced to the last entry per (uuid, variable) - by log order - with a
partial ``max_by`` aggregate, folded into one ``map<variable, new_value>`` per uuid
(bounded by the number of columns), and joined to the data once.  Each column the
log may touch becomes a ``when(map_contains_key(m, name), ...)`` - all columns in one
projection, one join for the whole log.

A value that doesn't parse as its column's type leaves the cell alone.  The change trail
comes from the same join: per touched cell the value before, the value after and what
was done, so a run can be read, reported and taken back (:func:`undo`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formsieve.functions.nulls import col

# Texts of the ``change`` column that mean "apply this entry".
TRUE_TEXTS = ["true", "yes", "1", "y", "t"]


def _change_is_true(log: DataFrame, change_col: str):
    c = col(change_col)
    if isinstance(log.schema[change_col].dataType, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(TRUE_TEXTS), F.lit(False))


def reduce_log(log: DataFrame, id_col: str = "uuid", variable: str = "variable", new_value: str = "new_value",
               change_col: str | None = "change", ord_col: str | None = "ord") -> DataFrame:
    """Entries to apply: ``change`` true, the last one per (id, variable) by ``ord_col``."""
    if change_col and change_col in log.columns:
        log = log.filter(_change_is_true(log, change_col))
    log = log.filter(col(id_col).isNotNull() & col(variable).isNotNull())
    order = col(ord_col) if ord_col and ord_col in log.columns else F.lit(0)
    return log.groupBy(col(id_col).cast("string").alias(id_col), col(variable).cast("string").alias(variable)) \
        .agg(F.max_by(col(new_value).cast("string"), order).alias(new_value))


def correctable(df: DataFrame, id_col: str, columns: Sequence[str] | None = None) -> list[str]:
    """The columns a log may write: all with a text form that reads back, but the id."""
    closed = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
    return [c for c in (columns or df.columns)
            if c != id_col and c in df.columns and not isinstance(df.schema[c].dataType, closed)]


def _fold(entries: DataFrame, id_col: str, variable: str, value: str) -> DataFrame:
    """One ``map<variable, value>`` per id, bounded by the schema's width."""
    return entries.groupBy(id_col).agg(
        F.map_from_entries(F.collect_list(F.struct(col(variable), col(value)))).alias("_fixes")) \
        .withColumnRenamed(id_col, "_fix_id")


def _with_fixes(df: DataFrame, log: DataFrame, id_col: str, variable: str, new_value: str, change_col: str | None,
                ord_col: str | None, targets: Sequence[str]) -> DataFrame:
    """The data joined once with each id's map of fixes (``_fixes``, null without any)."""
    # Only entries for real columns are folded, so one id's map is bounded by the
    # schema width however many junk variable names a log holds (those are reported by
    # ``unapplied_entries``).
    entries = reduce_log(log, id_col, variable, new_value, change_col, ord_col).filter(col(variable).isin(list(targets)))
    per_id = _fold(entries, id_col, variable, new_value)
    return df.join(per_id, col(id_col).cast("string") == F.col("_fix_id"), "left")


def _cell(df: DataFrame, c: str):
    """(is there an entry, its text, the parsed value, is it kept out because it doesn't parse)."""
    dtype = df.schema[c].dataType
    has, text = F.map_contains_key(F.col("_fixes"), F.lit(c)), F.try_element_at(F.col("_fixes"), F.lit(c))
    value = text if isinstance(dtype, T.StringType) else text.try_cast(dtype)
    return has, text, value, text.isNotNull() & value.isNull()


def _written(j: DataFrame, df: DataFrame, targets: Sequence[str]) -> DataFrame:
    updates = {}
    for c in targets:
        has, _, value, bad = _cell(df, c)
        updates[c] = F.when(has & ~bad, value).otherwise(col(c))
    return j.withColumns(updates) if updates else j


def apply_log(df: DataFrame, log: DataFrame, id_col: str = "uuid", variable: str = "variable",
              new_value: str = "new_value", change_col: str | None = "change", ord_col: str | None = "ord",
              columns: Sequence[str] | None = None) -> DataFrame:
    """``row[variable] = new_value`` where the row's id matches.

    Unknown ids and unknown variables change nothing, nor does a value that does not parse
    as the column's type (``unapplied_entries`` lists all three); a null new value empties
    the cell; an empty log is the identity."""
    targets = correctable(df, id_col, columns)
    j = _with_fixes(df, log, id_col, variable, new_value, change_col, ord_col, targets)
    return _written(j, df, targets).select(*[col(c) for c in df.columns])


# What was done with a cell that a log names.
CHANGED, SAME, UNPARSABLE = "changed", "value was already there", "value does not parse"
TRAIL_COLUMNS = ["variable", "before", "after", "entry", "outcome"]


def change_trail(df: DataFrame, log: DataFrame, id_col: str = "uuid", variable: str = "variable",
                 new_value: str = "new_value", change_col: str | None = "change", ord_col: str | None = "ord",
                 columns: Sequence[str] | None = None, row_id: str | None = None) -> DataFrame:
    """What :func:`apply_log` does to each cell: (id, variable, before, after, entry, outcome).

    ``before`` and ``after`` are the cell's text, ``entry`` the log's; a cell that stays has
    both alike.  One join and one projection, like the correction itself: the entries of a row are an
    array of structs, exploded.  Where ids repeat, ``row_id`` names a column that doesn't: it is
    kept beside the id, and :func:`undo` goes by it."""
    targets = correctable(df, id_col, columns)
    keys = list(dict.fromkeys([id_col] + ([row_id] if row_id else [])))
    j = _with_fixes(df, log, id_col, variable, new_value, change_col, ord_col, targets).filter(F.col("_fixes").isNotNull())
    cells = []
    for c in targets:
        has, text, value, bad = _cell(df, c)
        before, after = col(c).cast("string"), F.when(bad, col(c)).otherwise(value).cast("string")
        outcome = F.when(bad, F.lit(UNPARSABLE)).when(col(c).eqNullSafe(value), F.lit(SAME)).otherwise(F.lit(CHANGED))
        cells.append(F.when(has, F.struct(F.lit(c).alias("variable"), before.alias("before"), after.alias("after"),
                                          text.alias("entry"), outcome.alias("outcome"))))
    if not cells:
        cells = [F.lit(None).cast("struct<variable:string,before:string,after:string,entry:string,outcome:string>")]
    return j.select(*[col(k) for k in keys], F.inline_outer(F.array(*cells))).filter(F.col("variable").isNotNull())


def undo(df: DataFrame, trail: DataFrame, id_col: str = "uuid", row_id: str | None = None) -> DataFrame:
    """The data as it was before the run that left ``trail``.

    Goes by ``row_id`` if given.  Without it, an id whose rows differed before can't be told
    apart afterwards: that is an error, not a guess."""
    key = row_id or id_col
    changed = trail.filter(F.col("outcome") == CHANGED) \
        .groupBy(col(key).cast("string").alias(key), "variable") \
        .agg(F.min(F.struct("before")).alias("_a"), F.max(F.struct("before")).alias("_b"))
    same = F.col("_a").eqNullSafe(F.col("_b"))
    before = F.when(same, F.col("_a.before")).otherwise(
        F.raise_error(F.concat(F.lit("several rows had other values under one id, undo needs row_id: "), col(key))))
    per_id = _fold(changed.select(key, "variable", before.alias("before")), key, "variable", "before")
    j = df.join(per_id, col(key).cast("string") == F.col("_fix_id"), "left")
    return _written(j, df, correctable(df, key)).select(*[col(c) for c in df.columns])


def unapplied_entries(df: DataFrame, log: DataFrame, id_col: str = "uuid", variable: str = "variable",
                      change_col: str | None = "change", ord_col: str | None = "ord", new_value: str = "new_value") -> DataFrame:
    """Entries that cannot apply: unknown id, a variable that is not a column, or a value
    that does not parse as the column's type."""
    entries = reduce_log(log, id_col, variable, new_value, change_col, ord_col)
    ids = df.select(col(id_col).cast("string").alias(id_col)).distinct()
    targets = correctable(df, id_col)
    typed = [c for c in targets if not isinstance(df.schema[c].dataType, T.StringType)]
    bad = F.lit(False)
    for c in typed:
        bad = bad | ((col(variable) == c) & col(new_value).isNotNull() & col(new_value).try_cast(df.schema[c].dataType).isNull())
    unknown_id = entries.join(ids, id_col, "left_anti").withColumn("reason", F.lit("unknown id"))
    other = entries.withColumn("reason", F.when(~col(variable).isin(targets), F.lit("unknown variable"))
                               .when(bad, F.lit(UNPARSABLE))).filter(F.col("reason").isNotNull())
    return unknown_id.unionByName(other)
