"""Quality rules and the issue log.

Row rules are evaluated as ONE rule set in ONE scan: every rule becomes
``when(predicate, struct(rule_id, variable, issue, old_value))``; the array of those
structs is exploded with ``inline_outer`` and the null entries (rules that did not fire)
are filtered out - no lambda, so it all stays in generated code.  A null predicate never fires,
as a filter on ``ifelse(NA, 1, 0) == 1`` drops it.  No shuffle at all.

Duplicates are a partial aggregate of key counts joined back (never a window over a
possibly hot key).  Outliers are one global aggregate of per-column moments (one row,
bounded by the column count) and then one flagging projection over the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formsieve.functions.nulls import as_text, col, na_if_else
from formsieve.functions.text import day_difference, minutes_of_day, split_part
from formsieve.sources.io import ISSUE_LOG_COLUMNS

# The text written into every new log row.
DEFAULT_NEW_VALUE = " "
DEFAULT_FIX = "Checked with partner"
DEFAULT_CHECKED_BY = "ON"

LOG_COLUMNS = ISSUE_LOG_COLUMNS + ["rule_id"]


@dataclass
class Rule:
    """One row predicate and what it logs.

    ``variable`` and ``issue`` are text or Columns; ``old_value`` is a column name or
    Column, printed as text (integral doubles without ``.0``)."""
    rule_id: str
    predicate: Column
    variable: str | Column
    issue: str | Column
    old_value: str | Column | None = None
    extra: dict = field(default_factory=dict)


@dataclass
class LogContext:
    """Which data columns fill ``uuid``, ``agency`` and ``area`` of the log."""
    uuid: str = "uuid"
    agency: str = "q0_3_organization"
    area: str = "a4_site_name3"
    new_value: str = DEFAULT_NEW_VALUE
    fix: str = DEFAULT_FIX
    checked_by: str = DEFAULT_CHECKED_BY


def _lit_or_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _old_value_text(df: DataFrame, v) -> Column:
    if v is None:
        return F.lit(None).cast("string")
    if isinstance(v, Column):
        return v.cast("string")
    return as_text(v, df.schema[v].dataType if v in df.columns else None)


def rule_flags(df: DataFrame, rules: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """Q2 wide table: ``keep`` columns plus a 1/0/null flag per rule (``ifelse`` keeps NA)."""
    return df.select(*[col(c) for c in keep],
                     *[na_if_else(r.predicate, 1, 0).alias(r.rule_id) for r in rules])


def run_rules(df: DataFrame, rules: Sequence[Rule], ctx: LogContext = LogContext()) -> DataFrame:
    """Q2-Q10: all row rules in one scan -> the 9 log columns + ``rule_id``."""
    if not rules:
        return empty_log(df.sparkSession)
    entries = [
        F.when(r.predicate, F.struct(
            F.lit(r.rule_id).alias("rule_id"),
            _lit_or_col(r.variable).cast("string").alias("variable"),
            _lit_or_col(r.issue).cast("string").alias("issue"),
            _old_value_text(df, r.old_value).alias("old_value"),
        ))
        for r in rules
    ]
    # A plain array (a rule that does not fire leaves a null entry) - no lambda, so the
    # whole projection stays in generated code.
    hits = F.array(*entries)
    base = df.select(col(ctx.uuid).cast("string").alias("uuid"),
                     col(ctx.agency).cast("string").alias("agency"),
                     col(ctx.area).cast("string").alias("area"),
                     hits.alias("_hits"))
    # inline_outer + a null filter: a plain inline makes the optimizer infer
    # size(hits) > 0 and push it below, evaluating every rule twice per row; the filter
    # drops the null entries of rules that did not fire.
    exploded = base.select("uuid", "agency", "area", F.inline_outer("_hits")).filter(F.col("rule_id").isNotNull())
    return exploded.select(
        "uuid", "agency", "area", "variable", "issue", "old_value",
        F.lit(ctx.new_value).alias("new_value"), F.lit(ctx.fix).alias("fix"),
        F.lit(ctx.checked_by).alias("checked_by"), "rule_id")


def empty_log(spark) -> DataFrame:
    """W11 is not needed: an empty log keeps its schema."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in LOG_COLUMNS])
    return spark.createDataFrame([], schema)


# ---------------------------------------------------------------- rule builders

def range_rule(rule_id: str, c: str, lo: float, hi: float, issue: str,
               variable: str | None = None) -> Rule:
    """Value outside ``[lo, hi]``; logs the column and its value."""
    x = col(c)
    return Rule(rule_id, (x > hi) | (x < lo), variable or c, issue, c)


def any_equals(cols: Sequence[str], value) -> Column:
    """Chained ``==`` joined by ``|`` (Kleene logic keeps NA when nothing matches)."""
    out = None
    for c in cols:
        e = col(c) == value
        out = e if out is None else (out | e)
    return out


def in_set(c: str, values: Sequence) -> Column:
    """Equals any member of a set (null when the cell is null)."""
    return col(c).isin(list(values))


def prefix_rule(rule_id: str, c: str, prefixes: Sequence[str], issue: str) -> Rule:
    """A present value that does not start with any allowed prefix.

    (The intended rule: an anchored alternation, not a character class.)"""
    pattern = "^(" + "|".join(prefixes) + ")"
    x = col(c).cast("string")
    return Rule(rule_id, x.isNotNull() & ~x.rlike(pattern), c, issue, c)


# ---------------------------------------------------------------- duplicates

def frequency(df: DataFrame, c: str) -> DataFrame:
    """Frequency table of a column; nulls excluded."""
    return df.filter(col(c).isNotNull()).groupBy(col(c)).agg(F.count(F.lit(1)).alias("freq"))


def duplicated_rows(df: DataFrame, key: str, freq_col: str | None = "freq") -> DataFrame:
    """Every row whose non-null key occurs more than once, with its frequency.

    Counting is a partial aggregate (map-side combine); the join back runs as a
    broadcast when AQE measures the duplicate-key table small, else as a sort-merge
    join whose hot partitions AQE splits."""
    counts = frequency(df, key).filter(F.col("freq") > 1)
    out = df.join(counts.withColumnRenamed(key, "_dup_key"), col(key) == F.col("_dup_key"), "inner") \
        .drop("_dup_key")
    return out if freq_col == "freq" else (out.drop("freq") if freq_col is None else out.withColumnRenamed("freq", freq_col))


def duplicate_log(df: DataFrame, key: str, issue: str, ctx: LogContext, area: str | None = None,
                  rule_id: str = "Q1") -> DataFrame:
    """Q1: one log row per row of a duplicated key; the key is the logged value."""
    d = duplicated_rows(df, key, None)
    return d.select(col(ctx.uuid).cast("string").alias("uuid"),
                    col(ctx.agency).cast("string").alias("agency"),
                    col(area or ctx.area).cast("string").alias("area"),
                    F.lit(key).alias("variable"), F.lit(issue).alias("issue"),
                    as_text(key, df.schema[key].dataType).alias("old_value"),
                    F.lit(ctx.new_value).alias("new_value"), F.lit(ctx.fix).alias("fix"),
                    F.lit(ctx.checked_by).alias("checked_by"), F.lit(rule_id).alias("rule_id"))


def with_duplicate_flag(df: DataFrame, key: str, flag: str = "_dup_freq") -> DataFrame:
    """D2 for a rule set: every row, plus the frequency of its key when that key occurs
    more than once (null otherwise).  Key counts are a partial aggregate, joined back
    with a left join (one count row per key, so no row is repeated); the duplicate rule
    then runs in the same scan as the other row rules instead of a scan of its own."""
    counts = frequency(df, key).filter(F.col("freq") > 1) \
        .select(col(key).alias("_dup_key"), F.col("freq").alias(flag))
    return df.join(counts, col(key) == F.col("_dup_key"), "left").drop("_dup_key")


def duplicate_rule(key: str, issue: str, flag: str = "_dup_freq", rule_id: str = "Q1") -> Rule:
    """Q1 as a row rule over :func:`with_duplicate_flag`: the key is the logged value."""
    return Rule(rule_id, F.col(flag).isNotNull(), key, issue, key)


# ---------------------------------------------------------------- interview length (Q11)

SHORT_ISSUE = "form duration too short"
LONG_ISSUE = "form duration too long"
DURATION_VARIABLE = "Completion Duration (min)"


def durations(df: DataFrame, id_col: str = "uuid", start: str = "start", end: str = "end") -> DataFrame:
    """Same-day submissions with their length in minutes.

    Dates are the text before ``T``, clock times the text after it; a submission that
    spans days (or has no date) is dropped."""
    s_date, s_time = split_part(start, "T", 0), split_part(start, "T", 1)
    e_date, e_time = split_part(end, "T", 0), split_part(end, "T", 1)
    days = day_difference(e_date, s_date)
    return (df.select(col(id_col).alias(id_col), days.alias("_days"),
                      (minutes_of_day(e_time) - minutes_of_day(s_time)).alias("duration_min"))
            .filter(F.col("_days") == 0).drop("_days"))


def duration_issues(df: DataFrame, lower: float = 15, upper: float = 100, id_col: str = "uuid",
                    start: str = "start", end: str = "end") -> DataFrame:
    """Q11: ``(id, value, variable, has_issue, issue_type)`` for lengths ``<= lower`` or
    ``>= upper``.  A row that is both yields two rows, as binding the two subsets does."""
    d = durations(df, id_col, start, end)
    flags = F.array(F.when(F.col("duration_min") <= lower, F.lit(SHORT_ISSUE)),
                    F.when(F.col("duration_min") >= upper, F.lit(LONG_ISSUE)))
    return d.select(col(id_col), "duration_min", F.explode_outer(flags).alias("issue_type")) \
        .filter(F.col("issue_type").isNotNull()) \
        .select(col(id_col), F.col("duration_min").alias("value"),
                F.lit(DURATION_VARIABLE).alias("variable"), F.lit("TRUE").alias("has_issue"), "issue_type")


# ---------------------------------------------------------------- outliers

OUTLIER_NORMAL = "outlier (normal distribution)"
OUTLIER_LOG = "outlier (log-normal distribution)"


def numeric_moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    """Mean and sample sd per column, raw and log scale (log only of positive values).

    One global aggregate over one scan (partial per task, a handful of partial rows
    merged); the result is one row of four numbers per column, so it is read on the
    driver - a size bounded by the schema, not the data."""
    aggs = []
    for c in cols:
        v = col(c).cast("double")
        lv = F.when(v > 0, F.log(v))
        aggs += [F.avg(v), F.stddev_samp(v), F.avg(lv), F.stddev_samp(lv)]
    row = df.agg(*aggs).first()
    return {c: tuple(row[4 * i:4 * i + 4]) for i, c in enumerate(cols)}


def outliers(df: DataFrame, id_col: str, cols: Sequence[str], k: float = 3.0,
             log_scale: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """``(id, keep..., variable, value, issue_type)`` for values outside mean +- k sd
    (raw scale), and on the log scale for positive values.  Thresholds are parameters.

    The moments enter as literals, so flagging is one projection over the scan - the
    same one-array-per-row form as the rule runner - with no unpivot of every row and
    no join."""
    stats = numeric_moments(df, cols)
    entries = []
    for c in cols:
        mean, sd, mean_log, sd_log = stats[c]
        v = col(c).cast("double")
        if mean is not None and sd is not None:
            flag = F.abs(v - F.lit(mean)) > F.lit(k) * F.lit(sd)
            entries.append(F.when(flag, F.struct(F.lit(c).alias("variable"), v.alias("value"),
                                                 F.lit(OUTLIER_NORMAL).alias("issue_type"))))
        if log_scale and mean_log is not None and sd_log is not None:
            flag = F.abs(F.when(v > 0, F.log(v)) - F.lit(mean_log)) > F.lit(k) * F.lit(sd_log)
            entries.append(F.when(flag, F.struct(F.lit(c).alias("variable"), v.alias("value"),
                                                 F.lit(OUTLIER_LOG).alias("issue_type"))))
    if not entries:
        entries = [F.lit(None).cast("struct<variable:string,value:double,issue_type:string>")]
    hits = F.array(*entries)
    base = df.select(col(id_col), *[col(c) for c in keep], hits.alias("_hits"))
    out = base.select(col(id_col), *[col(c) for c in keep], F.inline_outer("_hits"))
    return out.filter(F.col("variable").isNotNull())


def outlier_log(df: DataFrame, cols: Sequence[str], ctx: LogContext, k: float = 3.0,
                log_scale: bool = True, rule_id: str = "Q12") -> DataFrame:
    """Q12: outliers in the 9-column log; area is the site name as in the reference."""
    keep = [c for c in dict.fromkeys([ctx.agency, ctx.area]) if c != ctx.uuid]
    o = outliers(df, ctx.uuid, cols, k, log_scale, keep)
    return o.select(col(ctx.uuid).cast("string").alias("uuid"),
                    col(ctx.agency).cast("string").alias("agency"),
                    col(ctx.area).cast("string").alias("area"),
                    F.col("variable"), F.col("issue_type").alias("issue"),
                    as_text("value", T.DoubleType()).alias("old_value"),
                    F.lit(ctx.new_value).alias("new_value"), F.lit(ctx.fix).alias("fix"),
                    F.lit(ctx.checked_by).alias("checked_by"), F.lit(rule_id).alias("rule_id"))


# ---------------------------------------------------------------- assembly (Q13)

def assemble_log(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name of log parts; every column is text."""
    from functools import reduce
    norm = [p.select(*[(col(c).cast("string") if c in p.columns else F.lit(None).cast("string")).alias(c)
                       for c in LOG_COLUMNS]) for p in parts]
    return reduce(lambda a, b: a.unionByName(b), norm)

