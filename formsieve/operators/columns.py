"""Projections and header operations.

All of these only rewrite the projection list; Catalyst folds them into the scan,
so a later action reads just the columns that survive (``ReadSchema``).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formsieve.functions.nulls import col


def select_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P1."""
    return df.select(*[col(c) for c in cols])


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` inclusive, in frame order."""
    names = df.columns
    i, j = names.index(first), names.index(last)
    if i > j:
        raise ValueError(f"{first!r} comes after {last!r}")
    return names[i:j + 1]


def column_slice(df: DataFrame, start: int, stop: int) -> list[str]:
    """Names by 1-based inclusive positions (J3: columns 18 to 147)."""
    return df.columns[start - 1:stop]


def select_range(df: DataFrame, first: str, last: str, keep: Sequence[str] = ()) -> DataFrame:
    """``select(keep..., first:last)``."""
    rng = column_range(df, first, last)
    return select_cols(df, list(keep) + [c for c in rng if c not in keep])


def match_columns(df: DataFrame, contains: str | None = None, starts_with: str | None = None,
                  ends_with: str | None = None, regex: str | None = None) -> list[str]:
    """Names matching a pattern; case is ignored, as the select helpers do."""
    out = []
    for c in df.columns:
        lc = c.lower()
        if contains is not None and contains.lower() not in lc:
            continue
        if starts_with is not None and not lc.startswith(starts_with.lower()):
            continue
        if ends_with is not None and not lc.endswith(ends_with.lower()):
            continue
        if regex is not None and not re.search(regex, c, flags=re.IGNORECASE):
            continue
        out.append(c)
    return out


def select_matching(df: DataFrame, keep: Sequence[str] = (), negate: bool = False, **pattern) -> DataFrame:
    """``keep`` columns plus those matching (or, with ``negate``, not matching)."""
    hits = set(match_columns(df, **pattern))
    chosen = [c for c in df.columns if (c in hits) != negate and c not in keep]
    return select_cols(df, list(keep) + chosen)


def drop_cols(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop; names that do not exist are ignored."""
    present = set(df.columns)
    return df.drop(*[c for c in cols if c in present])


def apply_policy(df: DataFrame, policies: Mapping[str, Sequence[str]], name: str) -> DataFrame:
    """P5: drop the columns of a named policy (raw / internal / external ...)."""
    return drop_cols(df, policies[name])


def rename_cols(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the names that exist; others are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def _rename_all(df: DataFrame, new_names: Sequence[str], strict: bool = False) -> DataFrame:
    """Positional rename (``toDF``); repeated names are allowed unless ``strict``."""
    if strict:
        lowered = [n.lower() for n in new_names]
        dup = {n for n in lowered if lowered.count(n) > 1}
        if dup:
            raise ValueError(f"header collision after rename: {sorted(dup)}")
    return df.toDF(*new_names)


def strip_group_prefix(df: DataFrame) -> DataFrame:
    """Drop everything up to the first dot of each header."""
    return _rename_all(df, [re.sub(r"^.*?\.", "", c, count=1) for c in df.columns])


def normalise_headers(df: DataFrame) -> DataFrame:
    """P10: non ``[A-Za-z0-9_]`` characters become ``.``, then lower case."""
    return _rename_all(df, [re.sub(r"[^a-zA-Z0-9_]", ".", c).lower() for c in df.columns])


def lower_headers(df: DataFrame) -> DataFrame:
    """Lower-case headers; a collision is an error."""
    return _rename_all(df, [c.lower() for c in df.columns], strict=True)


def prefix_headers(df: DataFrame, prefix: str = "@", cols: Sequence[str] | None = None) -> DataFrame:
    """P12."""
    target = set(cols if cols is not None else df.columns)
    return _rename_all(df, [prefix + c if c in target else c for c in df.columns])


def keep_first_duplicate_headers(df: DataFrame) -> DataFrame:
    """Of repeated header names keep the first column."""
    seen, idx = set(), []
    for i, c in enumerate(df.columns):
        if c not in seen:
            seen.add(c)
            idx.append(i)
    if len(idx) == len(df.columns):
        return df
    # Positional selection is the only way to tell same-named columns apart.
    tmp = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return tmp.select(*[F.col(f"_c{i}").alias(df.columns[i]) for i in idx])


def uuid_header(df: DataFrame) -> DataFrame:
    """The first header containing ``uuid`` becomes ``uuid``."""
    for c in df.columns:
        if "uuid" in c and c != "uuid":
            return df.withColumnRenamed(c, "uuid")
    return df


def add_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Constant columns (country, version, reviewer, placeholders)."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def reorder_columns(df: DataFrame, moves: Sequence[tuple]) -> DataFrame:
    """Apply moves in order.  A move is ``(cols, 'first')``, ``(cols, 'last')``,
    ``(cols, 'before', anchor)`` or ``(cols, 'after', anchor)``; an unknown anchor is an
    error.  Only the projection changes."""
    order = list(df.columns)
    for mv in moves:
        cols, where = mv[0], mv[1]
        cols = [cols] if isinstance(cols, str) else list(cols)
        missing = [c for c in cols if c not in order]
        if missing:
            raise ValueError(f"unknown columns {missing}")
        rest = [c for c in order if c not in cols]  # U5: name-set difference
        if where == "first":
            order = cols + rest
        elif where == "last":
            order = rest + cols
        elif where in ("before", "after"):
            anchor = mv[2]
            if anchor not in rest:
                raise ValueError(f"unknown anchor {anchor!r}")
            k = rest.index(anchor) + (1 if where == "after" else 0)
            order = rest[:k] + cols + rest[k:]
        else:
            raise ValueError(f"unknown move {where!r}")
    return select_cols(df, order)

