"""Unions over form versions whose columns changed type.

Types form a lattice::

    long < double < text        date < timestamp < text        boolean < text

A column's common type is the least one that holds every version's type; text holds all.
Each part is brought to the common types by one projection, and a cell that its type can't hold -
text that doesn't parse, a number with a fraction or out of range, a time of day in a date -
becomes null there and is listed as a reject: no cell stops a job, none vanishes unseen.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formsieve.functions.nulls import col, num_to_text

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
REAL = (T.FloatType, T.DoubleType, T.DecimalType)
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)

# Columns of the reject list.
REJECT_COLUMNS = ["part", "key", "variable", "value", "wanted"]


def _rank(t: T.DataType) -> tuple[str, int]:
    """(family, place in it); a type of no family stands for itself."""
    if isinstance(t, WHOLE):
        return "number", 0
    if isinstance(t, REAL):
        return "number", 1
    if isinstance(t, TIMES):
        return "time", int(not isinstance(t, T.DateType))
    return ("text" if isinstance(t, T.StringType) else t.simpleString()), 0


def common_type(types: Sequence[T.DataType], on_text: str = "text") -> T.DataType:
    """The least type that holds all ``types``.

    ``on_text="text"``: a version with text makes the column text.  ``on_text="typed"``: text versions
    are read as the others' type, and what doesn't parse is a reject.  Structures join only with themselves."""
    if on_text not in ("text", "typed"):
        raise ValueError("on_text is 'text' or 'typed'")
    types = [t for t in types if not isinstance(t, T.NullType)]
    if not types:
        return T.StringType()
    if all(t == types[0] for t in types):
        return types[0]
    nested = [t for t in types if isinstance(t, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    if nested:
        raise ValueError(f"no common type of {sorted({t.simpleString() for t in types})}")
    typed = [t for t in types if not isinstance(t, T.StringType)]
    if on_text == "text" and len(typed) < len(types):
        return T.StringType()
    families = {_rank(t)[0] for t in typed}
    if len(families) > 1:
        return T.StringType()
    if len(set(map(str, typed))) == 1:
        return typed[0]
    top = max(_rank(t)[1] for t in typed)
    if families == {"number"}:
        return T.DoubleType() if top else T.LongType()
    return T.TimestampType() if top else T.DateType()


def version_schema(frames: Sequence[DataFrame], template: T.StructType | None = None, on_text: str = "text") -> T.StructType:
    """The union's columns: the template's as they are, then the parts' own by first appearance, each of its common type."""
    fields = {f.name: f.dataType for f in template.fields} if template is not None else {}
    seen: dict[str, list[T.DataType]] = {}
    for f in (f for df in frames for f in df.schema.fields):
        seen.setdefault(f.name, []).append(f.dataType)
    for name, types in seen.items():
        if name not in fields:
            fields[name] = common_type(types, on_text)
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def fit(c, have: T.DataType, want: T.DataType) -> Column:
    """A cell as ``want``, null if that can't hold it; equal types are left alone."""
    c = col(c)
    if have == want:
        return c
    if isinstance(want, T.StringType):
        return num_to_text(c, have)
    if isinstance(have, T.NullType):
        return c.cast(want)
    if isinstance(want, WHOLE):
        if isinstance(have, WHOLE):
            return c.cast("string").try_cast(want)
        number = F.trim(c) if isinstance(have, T.StringType) else c
        real = number.cast("string").try_cast("double")
        whole = F.when((real == F.floor(real)) & (F.abs(real) < 2.0 ** 63), real.try_cast(want))
        return F.coalesce(number.cast("string").try_cast(want), whole) if isinstance(have, T.StringType) else whole
    if isinstance(want, T.DateType) and isinstance(have, (T.TimestampType, T.TimestampNTZType)):
        return F.when(F.date_trunc("day", c) == c, c.cast("date"))
    if isinstance(have, T.StringType):
        return F.trim(c).try_cast(want)
    if _rank(have)[0] == _rank(want)[0]:
        return c.cast(want) if not isinstance(want, T.DecimalType) else c.try_cast(want)
    return F.lit(None).cast(want)


def _fitted_part(df: DataFrame, schema: T.StructType) -> DataFrame:
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[(fit(f.name, have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                       for f in schema.fields])


def fitted(frames: Sequence[DataFrame], template: T.StructType | None = None, on_text: str = "text") -> DataFrame:
    """The parts under one another, each cell as its column's type or null."""
    schema = version_schema(frames, template, on_text)
    return reduce(DataFrame.unionByName, [_fitted_part(df, schema) for df in frames])


def _rejects(df: DataFrame, part: int, schema: T.StructType, key: str | None) -> DataFrame:
    """The part's cells that their columns can't hold: one projection, no shuffle."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cells = []
    for f in schema.fields:
        if f.name in have and have[f.name] != f.dataType and not isinstance(f.dataType, T.StringType):
            bad = col(f.name).isNotNull() & fit(f.name, have[f.name], f.dataType).isNull()
            cells.append(F.when(bad, F.struct(F.lit(f.name).alias("variable"), num_to_text(f.name, have[f.name]).alias("value"),
                                              F.lit(f.dataType.simpleString()).alias("wanted"))))
    cells = cells or [F.lit(None).cast("struct<variable:string,value:string,wanted:string>")]
    own = (col(key).cast("string") if key is not None and key in have else F.lit(None).cast("string")).alias("key")
    return df.select(F.lit(part).alias("part"), own, F.inline_outer(F.array(*cells))).filter(F.col("variable").isNotNull())


def union_versions(frames: Sequence[DataFrame], template: T.StructType | None = None, key: str | None = None,
                   on_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(union, rejects): the parts on their common types, and every cell that did not fit, by
    part number (from 1), ``key`` and column."""
    schema = version_schema(frames, template, on_text)
    union = reduce(DataFrame.unionByName, [_fitted_part(df, schema) for df in frames])
    rejects = reduce(DataFrame.unionByName, [_rejects(df, i, schema, key) for i, df in enumerate(frames, 1)])
    return union, rejects
