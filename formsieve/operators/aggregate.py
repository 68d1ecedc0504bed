"""Aggregations.

Everything here is a ``groupBy`` with partial aggregation; "top per group" and shares
are windows over the AGGREGATED rows (one group's categories), never over raw rows,
so a group holding a third of all rows is combined map-side and never lands whole in
one task, and the data is scanned once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formsieve.functions.nulls import col, strict_sum
from formsieve.functions.text import to_number


def _keys(group: str | Sequence[str]) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def drop_null_keys(df: DataFrame, group: str | Sequence[str]) -> DataFrame:
    """Groups with a null key are dropped, as ``aggregate`` does."""
    cond = None
    for k in _keys(group):
        e = col(k).isNotNull()
        cond = e if cond is None else cond & e
    return df.filter(cond) if cond is not None else df


def group_count(df: DataFrame, group: str | Sequence[str], out: str = "n") -> DataFrame:
    """D3: rows per group."""
    g = _keys(group)
    return drop_null_keys(df, g).groupBy(*[col(k) for k in g]).agg(F.count(F.lit(1)).alias(out))


def group_strict_sums(df: DataFrame, group: str | Sequence[str], sums: dict[str, str],
                      numeric_text: bool = True) -> DataFrame:
    """Per group ``out = strict sum of to_number(column)``; one null makes it null."""
    g = _keys(group)
    aggs = [strict_sum(to_number(c) if numeric_text else col(c)).alias(out) for out, c in sums.items()]
    return drop_null_keys(df, g).groupBy(*[col(k) for k in g]).agg(*aggs)


def weighted_votes(df: DataFrame, group: str | Sequence[str], category: str, weight: str,
                   out: str = "x") -> DataFrame:
    """Strict sum of the weight per (group, category)."""
    g = _keys(group) + [category]
    return drop_null_keys(df, g).groupBy(*[col(k) for k in g]) \
        .agg(strict_sum(to_number(weight)).alias(out))


def top1_with_ties(df: DataFrame, group: str | Sequence[str], value: str) -> DataFrame:
    """Rows whose ``value`` equals the group maximum; ties kept, null values dropped.

    Meant for aggregated input (one row per group and category, as the weighted votes
    are): the maximum is a window over those rows, so the votes are computed once and a
    window partition holds one group's categories - never the group's raw rows."""
    g = _keys(group)
    best = F.max(col(value)).over(Window.partitionBy(*[col(k) for k in g]))
    return df.filter(col(value).isNotNull()).withColumn("_best", best) \
        .filter(col(value) == F.col("_best")).drop("_best")


def top1_first(df: DataFrame, group: str | Sequence[str], value: str, tie_break: str) -> DataFrame:
    """B10 option ``ties='first'``: one row per group, lowest ``tie_break`` among ties."""
    g = _keys(group)
    others = [c for c in df.columns if c not in g]
    best = df.filter(col(value).isNotNull()).groupBy(*[col(k) for k in g]).agg(
        F.max_by(F.struct(*[col(c).alias(c) for c in others]),
                 F.struct(col(value), -col(tie_break))).alias("_best"))
    return best.select(*g, "_best.*")


def weighted_mode(df: DataFrame, group: str, category: str, weight: str, out: str,
                  ties: str = "all") -> DataFrame:
    """The category with the largest strict weight sum per group.

    ``ties='all'`` keeps every tied category (so a later join fans out);
    ``ties='first'`` keeps the smallest category among ties."""
    votes = weighted_votes(df, group, category, weight, "_w")
    top = top1_with_ties(votes, group, "_w")
    if ties == "first":
        return top.groupBy(col(group)).agg(F.min(col(category)).alias(out))
    return top.select(col(group).alias(group), col(category).alias(out))


def weighted_modes(df: DataFrame, group: str, specs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """D6 for several (category, weight, out) triples in ONE pass: the pairs are unpivoted
    (Expand, in the scan's stage), strict-summed in one partial aggregate and the top
    per (out, group) taken with ties.  Long result ``(group, indicator, value)``."""
    pairs = F.array(*[F.struct(F.lit(o).alias("ind"), col(c).cast("string").alias("cat"),
                               to_number(w).alias("w")) for c, w, o in specs])
    long = df.select(col(group).alias(group), F.inline(pairs)) \
        .filter(col(group).isNotNull() & F.col("cat").isNotNull())
    votes = long.groupBy(col(group), "ind", "cat").agg(strict_sum("w").alias("_w"))
    top = top1_with_ties(votes, [group, "ind"], "_w")
    return top.select(col(group), F.col("ind").alias("indicator"), F.col("cat").alias("value"))


def modes_by_indicator(long: DataFrame, group: str, names: Sequence[str]) -> list[DataFrame]:
    """The long result of ``weighted_modes`` as one ``(group, name)`` frame per indicator,
    ready for a left-join chain (ties fan out there, as joining the tables does).  The
    small long result is checkpointed once so the frames do not recompute it."""
    from formsieve.session import materialize
    fixed = materialize(long)
    return [fixed.filter(F.col("indicator") == n).select(col(group), F.col("value").alias(n)) for n in names]


def mode_first_seen(df: DataFrame, group: str | Sequence[str], value: str, ord_col: str,
                    out: str = "mode") -> DataFrame:
    """Most frequent value per group; ties go to the value seen first (lowest
    ``ord_col``).  A null value counts as a value.  Two partial aggregates."""
    g = _keys(group)
    counts = df.groupBy(*[col(k) for k in g], col(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(col(ord_col)).alias("_first"))
    return counts.groupBy(*[col(k) for k in g]).agg(
        F.max_by(F.col("_v"), F.struct(F.col("_n"), F.lit(0) - F.col("_first"))).alias(out))


def share_within(df: DataFrame, group: Sequence[str], count_col: str = "n", out: str = "share") -> DataFrame:
    """``count / sum(count)`` within the group, for aggregated counts (a window over
    one group's aggregated rows)."""
    return df.withColumn(out, col(count_col) / F.sum(col(count_col)).over(
        Window.partitionBy(*[col(k) for k in group])))


def any_not_null(df: DataFrame, group: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per group, whether each column has any non-null value (``has_<col>``)."""
    return df.groupBy(*[col(k) for k in group]).agg(
        *[F.bool_or(col(c).isNotNull()).alias(f"has_{c.replace('.', '_')}") for c in cols])


def multiple_response_by_prefix(df: DataFrame, question: str, group: str | None = None) -> DataFrame:
    """D11 by question: the option columns are those named ``<question>.<option>``; the
    ``question`` column is the option name."""
    prefix = question + "."
    options = [c for c in df.columns if c.startswith(prefix)]
    if not options:
        raise ValueError(f"no option columns for {question!r}")
    return multiple_response(df, options, group, [c[len(prefix):] for c in options])


def multiple_response(df: DataFrame, options: Sequence[str], group: str | None = None,
                      option_names: Sequence[str] | None = None) -> DataFrame:
    """Per option the number of non-zero answers, percent of all responses and
    percent of respondents (cases), plus a ``Total`` row, per ``group`` if given.

    ``!= 0`` and the sums keep NA (a null flag makes its option's count null).  One
    aggregate pass: the per-row "answered at least one" flag is computed before it."""
    names = list(option_names or options)
    nz = [(col(c).cast("double") != 0).cast("long") for c in options]
    row_sum = None
    for c in options:
        v = col(c).cast("double")
        row_sum = v if row_sum is None else row_sum + v
    respondent = (row_sum != 0).cast("long")
    keys = [col(group)] if group else []
    base = df.select(*([col(group)] if group else []), *[e.alias(f"_o{i}") for i, e in enumerate(nz)],
                     respondent.alias("_resp"))
    agg = base.groupBy(*keys).agg(*[strict_sum(f"_o{i}").alias(f"_o{i}") for i in range(len(options))],
                                  strict_sum("_resp").alias("_cases"))
    total = None
    for i in range(len(options)):
        total = F.col(f"_o{i}") if total is None else total + F.col(f"_o{i}")
    agg = agg.withColumn("_total", total)
    stacked = F.array(*[F.struct(F.lit(n).alias("question"), F.col(f"_o{i}").alias("freq"))
                        for i, n in enumerate(names)],
                      F.struct(F.lit("Total").alias("question"), F.col("_total").alias("freq")))
    out = agg.select(*([col(group)] if group else []), "_total", "_cases", F.inline(stacked))
    return out.select(*([col(group)] if group else []), "question",
                      F.col("freq").cast("double").alias("freq"),
                      (F.col("freq") / F.col("_total") * 100).alias("percent"),
                      (F.col("freq") / F.col("_cases") * 100).alias("percentofcases"))
