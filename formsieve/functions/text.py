"""Text functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from formsieve.functions.nulls import col


# The whitespace set of a regex ``\s`` (space, tab, newline, vertical
# tab, form feed, carriage return).
WHITESPACE = " \t\n\x0b\f\r"


def trim_ws(c) -> Column:
    r"""strip all leading and trailing whitespace (Spark ``trim`` strips blanks only).

    ``btrim`` with the ``\s`` set: the same result as a ``^\s+|\s+$`` replacement
    without running a regex over whole texts."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def replace_all(c, pattern: str, replacement: str) -> Column:
    """replace every literal occurrence (no regex involved)."""
    return F.replace(col(c), F.lit(pattern), F.lit(replacement))


def replace_first(c, pattern: str, replacement: str) -> Column:
    """replace the first literal occurrence only (``a_b_c`` -> ``a-b_c``)."""
    rep = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(col(c), "(?s)^(.*?)" + re.escape(pattern), "$1" + rep)


def normalise_cell(c) -> Column:
    """F8: every character outside ``[A-Za-z0-9_]`` becomes ``.``, then lower case."""
    return F.lower(F.regexp_replace(col(c), "[^a-zA-Z0-9_]", "."))


def normalise_name(name: str) -> str:
    """P10 on a header."""
    return re.sub(r"[^a-zA-Z0-9_]", ".", name).lower()


def matches(c, pattern: str) -> Column:
    """Regex test that is false (not null) on a null cell, like ``grepl``.

    A pattern that is only ``|``-separated literal words is run as ``contains`` tests,
    which give the same answer without the regex engine."""
    x = col(c)
    if re.fullmatch(r"[A-Za-z0-9_ ]+(\|[A-Za-z0-9_ ]+)*", pattern):
        hit = None
        for word in pattern.split("|"):
            e = x.contains(word)
            hit = e if hit is None else hit | e
        return F.coalesce(hit, F.lit(False))
    return F.coalesce(x.rlike(pattern), F.lit(False))


def to_number(c) -> Column:
    """text to double; unparsable text becomes null (ANSI-safe)."""
    return col(c).cast("string").try_cast("double")


def split_part(c, sep: str, index: int) -> Column:
    """the ``index``-th (0-based) piece of a split on a literal separator; null if absent."""
    return F.try_element_at(F.split(col(c), re.escape(sep)), F.lit(index + 1))


def minutes_of_day(time_text) -> Column:
    """``HH:MM:SS[.fff][+zz:zz]`` to minutes after midnight, rounded half-even to 2.

    Fractions of a second and the offset are ignored, as a ``%H:%M:%S`` parse does.
    One regex per cell; the three fields come from splitting its match."""
    hms = F.regexp_extract(col(time_text), r"^(\d{1,2}:\d{1,2}:\d{1,2})", 1)
    parts = F.split(hms, ":")
    h, m, s = (F.try_element_at(parts, F.lit(i)).try_cast("double") for i in (1, 2, 3))
    return F.bround(h * 60 + m + s / 60, 2)


def day_difference(end_date, start_date) -> Column:
    """whole days between two ``yyyy-MM-dd`` texts."""
    return F.datediff(col(end_date).try_cast("date"), col(start_date).try_cast("date"))
