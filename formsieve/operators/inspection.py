"""Batch inspection beyond outliers and ids (D15): free-text answers and sensitive columns.

One aggregate profiles every column.  Its groups are (column, answer): columns of free-text
answers to "other" give each answer and how often it came; every other column gives one group with its
count, moments, approximate number of distinct values (a mergeable sketch) and how many values have the shape of
a phone number, an e-mail address or a coordinate pair.  Tasks merge their groups before
anything is shuffled, so what moves is one row per task and column, and the different
free-text answers.

The findings have the inspection's columns; :func:`formsieve.functions.text.matches` on
``issue_type`` drops the kinds a workflow doesn't want (W5).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formsieve.functions.nulls import col, num_to_text
from formsieve.functions.text import matches

# Issue types of the inspection, as workflows filter them.
ISSUE_OTHER = "'other' response. may need recoding."
ISSUE_SENSITIVE = "Potentially sensitive information."

#: Headers of free-text answers to "other", and of columns that tell who or where somebody is.
OTHER_NAME = r"(?i)(^|[._/])other(s)?([._/](text|specify))?$"
SENSITIVE_NAME = r"(?i)(^|[._/])(phone|mobile|telephone|email|e_mail|gps|latitude|longitude|contact|respondent|head_of_household)([._/]|$)"

#: Shapes of values; a column is sensitive by content if at least ``SHARE`` of its values have one.
SHAPES = {
    "phone": r"^\+?[0-9][0-9 ()./-]{6,18}[0-9]$",
    "email": r"^[^@\s]+@[^@\s]+\.[A-Za-z]{2,}$",
    "coordinates": r"^-?[0-9]{1,3}\.[0-9]{3,}[ ,;]+-?[0-9]{1,3}\.[0-9]{3,}",
}
SHARE = 0.5
#: A shape needs so many different values: a code that looks like a number isn't somebody's.
LEAST_DISTINCT = 20

FINDINGS = ["variable", "value", "n", "issue_type"]


def profile(df: DataFrame, columns: Sequence[str] | None = None, other_pattern: str = OTHER_NAME) -> DataFrame:
    """(variable, kind, answer, n, n_distinct, mean, sd, phone, email, coordinates), from one aggregate.

    ``kind`` is ``other`` (a row per answer), ``text`` or ``number`` (a row per column).  ``n`` counts values that aren't
    null; ``n_distinct`` is approximate (sketch)."""
    columns = list(columns) if columns is not None else df.columns
    entries = []
    for c in columns:
        t = df.schema[c].dataType
        number = isinstance(t, T.NumericType)
        if not number and not isinstance(t, T.StringType):
            continue
        free = not number and re.search(other_pattern, c) is not None
        text = num_to_text(c, t)
        entries.append(F.struct(F.lit(c).alias("variable"), F.lit("other" if free else "number" if number else "text").alias("kind"),
                                (F.trim(col(c)) if free else F.lit(None).cast("string")).alias("answer"), text.alias("v"),
                                (col(c).cast("double") if number else F.lit(None).cast("double")).alias("x")))
    if not entries:
        raise ValueError("no text or number column to inspect")
    long = df.select(F.inline(F.array(*entries))).filter(F.col("v").isNotNull())
    # numbers have one shape at most, that of nothing sensitive: only text is tried
    shapes = [F.count_if((F.col("kind") == "text") & F.col("v").rlike(p)).alias(k) for k, p in SHAPES.items()]
    return long.groupBy("variable", "kind", "answer").agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("v").alias("n_distinct"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"), *shapes)


def findings(profiled: DataFrame, sensitive_pattern: str = SENSITIVE_NAME, share: float = SHARE, least_distinct: int = LEAST_DISTINCT) -> DataFrame:
    """(variable, value, n, issue_type): every free-text answer with its number of instances, and every sensitive
    column with the shape that gave it away (``name`` for its header)."""
    other = profiled.filter((F.col("kind") == "other") & (F.col("answer") != "")) \
        .select("variable", F.col("answer").alias("value"), "n", F.lit(ISSUE_OTHER).alias("issue_type"))
    shape = F.lit(None).cast("string")
    for k in reversed(SHAPES):
        shape = F.when((F.col(k) >= F.lit(share) * F.col("n")) & (F.col("n_distinct") >= least_distinct), F.lit(k)).otherwise(shape)
    sensitive = profiled.filter(F.col("kind") != "other") \
        .select("variable", F.when(matches("variable", sensitive_pattern), F.lit("name")).otherwise(shape).alias("value"), "n",
                F.lit(ISSUE_SENSITIVE).alias("issue_type")).filter(F.col("value").isNotNull())
    return other.unionByName(sensitive)


def without_kinds(found: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """The findings whose issue type matches none of ``patterns``; a null type stays."""
    for p in patterns:
        found = found.filter(~matches("issue_type", p))
    return found
