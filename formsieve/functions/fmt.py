"""Number formatting for report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formsieve.functions.nulls import col, num_to_text, paste


def pct100(c, digits: int = 0) -> Column:
    """share to percent, rounded half to even."""
    return F.bround(col(c) * 100, digits)


def fmt_number(x: Column, digits: int) -> Column:
    """A double rounded half-even and printed without a trailing ``.0``; null stays ``NA``."""
    return F.coalesce(num_to_text(F.bround(x, digits)), F.lit("NA"))


def fmt_percent(x: Column) -> Column:
    """``45%`` from 0.4512: round to 2, times 100, round to 0 (both half-even)."""
    return F.concat(F.coalesce(num_to_text(F.bround(F.bround(x, 2) * 100, 0)), F.lit("NA")), F.lit("%"))


def format_result(numbers, lo, hi, is_percent: Column, has_confints: Column,
                  max_digits_non_percent: int = 2) -> Column:
    """F16: ``45% (40%-50%)`` / ``12.5 (10.1-14.9)``; all-zero collapses to ``0%`` / ``0``.

    Without an interval the text keeps the trailing blank that joining with a blank
    leaves (``45% ``).  The two variants of the workflow differ only in the digits of a
    non-percent upper bound, hence ``max_digits_non_percent``."""
    n, lo, hi = col(numbers).cast("double"), col(lo).cast("double"), col(hi).cast("double")
    n_txt = F.when(is_percent, fmt_percent(n)).otherwise(fmt_number(F.bround(n, 2), 2))
    lo_txt = F.when(is_percent, fmt_percent_unrounded(lo)).otherwise(fmt_number(lo, 2))
    hi_txt = F.when(is_percent, fmt_percent_unrounded(hi)).otherwise(fmt_number(hi, max_digits_non_percent))
    interval = F.when(has_confints, F.concat(F.lit("("), lo_txt, F.lit("-"), hi_txt, F.lit(")"))) \
        .otherwise(F.lit(""))
    text = F.concat_ws(" ", n_txt, interval)
    return F.when(text == "0 (0-0)", F.lit("0")).when(text == "0% (0%-0%)", F.lit("0%")).otherwise(text)


def fmt_percent_unrounded(x: Column) -> Column:
    """Interval bounds are multiplied by 100 and rounded once (no 2-digit pre-round)."""
    return F.concat(F.coalesce(num_to_text(F.bround(x * 100, 0)), F.lit("NA")), F.lit("%"))


def format_results(results: DataFrame, analysis_keys: list[str], is_percent_col: str = "is_percent",
                   max_digits_non_percent: int = 2, out_col: str = "formatted") -> DataFrame:
    """F16 + D14 over a long result table: ``has_confints`` is an any-not-null aggregate
    per analysis, taken as a window over the (aggregated) result rows so the results
    are computed once."""
    w = Window.partitionBy(*[col(k) for k in analysis_keys])
    flagged = results.withColumn("has_confints", F.bool_or(F.col("min").isNotNull() | F.col("max").isNotNull()).over(w))
    return flagged.withColumn(out_col, format_result("numbers", "min", "max", col(is_percent_col),
                                                     F.col("has_confints"), max_digits_non_percent))


def blank_interval(results: DataFrame, where: Column | None = None) -> DataFrame:
    """``min`` and ``max`` set to null (only on the rows where ``where`` holds, if given)."""
    if where is None:
        return results.withColumns({"min": F.lit(None).cast("double"), "max": F.lit(None).cast("double")})
    return results.withColumns({c: F.when(~where, F.col(c)) for c in ("min", "max")})


def map_path(name, prefix: str, suffix: str) -> Column:
    """report map path ``prefix + name + suffix``; a null name prints as ``NA``."""
    return paste(prefix, col(name), suffix)
