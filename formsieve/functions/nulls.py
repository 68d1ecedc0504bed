"""Expressions that keep the null rules of the statistical workflow."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c) -> Column:
    """Column by name, back-quoted so dotted names (``question.option``) resolve."""
    if isinstance(c, Column):
        return c
    return F.col(f"`{c}`") if "." in c and not c.startswith("`") else F.col(c)


def na_if_else(cond: Column, yes, no) -> Column:
    """if/else that stays null when the condition is null.

    ``when(c, a).otherwise(b)`` would turn an unknown condition into ``b``."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond, yes).when(~cond, no)


def strict_sum(c) -> Column:
    """Sum that is null as soon as one input is null (no ``na.rm``)."""
    c = col(c)
    return F.when(F.count(F.lit(1)) == F.count(c), F.sum(c))


def num_to_text(c, dtype: T.DataType | None = None) -> Column:
    """value as text; integral doubles print without ``.0`` (1 -> "1")."""
    c = col(c)
    if dtype is not None and not isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return c.cast("string")
    d = c.cast("double")
    integral = (d == F.floor(d)) & (F.abs(d) < F.lit(1e15))
    return F.when(c.isNull(), F.lit(None).cast("string")) \
        .when(integral, d.cast("long").cast("string")) \
        .otherwise(c.cast("string"))


def as_text(c, dtype: T.DataType | None = None) -> Column:
    """Any value as text for a log column; numbers via :func:`num_to_text`."""
    if dtype is not None and isinstance(dtype, T.StringType):
        return col(c)
    return num_to_text(c, dtype)


def na_text(c) -> Column:
    """F4 helper: the text of a value, null printed as ``NA``."""
    return F.coalesce(col(c).cast("string"), F.lit("NA"))


def paste(*parts, sep: str = "") -> Column:
    """concatenate; nulls print as ``NA``.  Strings are literals, Columns are columns."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    cols = [F.coalesce(c.cast("string"), F.lit("NA")) for c in cols]
    return F.concat_ws(sep, *cols) if sep else F.concat(*cols)


def join_on(left, right, keys, how: str = "inner"):
    """Equi-join on same-named keys; names with dots are renamed around the join
    (a name list in ``join(on=...)`` is not back-quoted by Spark)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if all("." not in k for k in keys):
        return left.join(right, keys, how)
    ren = {k: f"_jk{i}" for i, k in enumerate(keys)}
    j = left.withColumnsRenamed(ren).join(right.withColumnsRenamed(ren), list(ren.values()), how)
    return j.withColumnsRenamed({v: k for k, v in ren.items()})


def fill_values(df, value, subset):
    """``fillna`` that accepts dotted column names."""
    return df.withColumns({c: F.coalesce(col(c), F.lit(value)) for c in subset})


def is_na(c) -> Column:
    """F17."""
    return col(c).isNull()
