"""Sequential site codes and global numbering.

A bare ``row_number().over(Window.orderBy(...))`` moves every row into one partition.
``global_rank`` numbers rows in a total order without that: range-partition on the
order (a unique tie-break key splits even a hot value over many partitions), sort
inside partitions, checkpoint so partition contents are fixed, count rows per
partition (one row per partition, so the offsets table has a proven size bound and is
broadcast), and add offset + position inside the partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formsieve.functions.nulls import col, paste
from formsieve.functions.text import replace_first
from formsieve.session import materialize

# The code range of new sites; numbering restarts after the last code.
FIRST_SITE_NUMBER = 1185
LAST_SITE_NUMBER = 5000
# A site code: district, then ``_`` or ``-``, then the number.
CODE_PATTERN = r"^(.*)[_-](\d+)$"


def _sort_exprs(order: Sequence) -> list[Column]:
    out = []
    for o in order:
        out.append(o if isinstance(o, Column) else col(o).asc_nulls_first())
    return out


def sort_nulls_first(df: DataFrame, cols: Sequence[str], tie_break: str) -> DataFrame:
    """O1: ascending sort with nulls first; the original row number breaks ties (stable)."""
    return df.orderBy(*_sort_exprs(list(cols) + [tie_break]))


def global_rank(df: DataFrame, order: Sequence, out_col: str = "rn",
                num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row in ``order`` (which must be a total order).

    Strings in ``order`` sort ascending with nulls first; Columns are used as given."""
    exprs = _sort_exprs(order)
    # Without an explicit count AQE sizes the range partitions from the data (a few
    # for a few thousand new sites, many at scale); an explicit count is kept as given.
    ranged = (df.repartitionByRange(num_partitions, *exprs) if num_partitions
              else df.repartitionByRange(*exprs)).sortWithinPartitions(*exprs)
    tagged = ranged.withColumns({"_pid": F.spark_partition_id(),
                                 "_mid": F.monotonically_increasing_id()})
    tagged = materialize(tagged)
    per_part = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a bounded table, so the window and the broadcast are cheap.
    offsets = per_part.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    pos_in_part = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = tagged.join(F.broadcast(offsets.select("_pid", "_off")), "_pid") \
        .withColumn(out_col, F.col("_off") + pos_in_part + 1)
    return out.drop("_pid", "_mid", "_off")


def assign_site_codes(df: DataFrame, code_col: str, name_col: str, district_col: str, ord_col: str,
                      first: int = FIRST_SITE_NUMBER, last: int = LAST_SITE_NUMBER,
                      num_partitions: int | None = None) -> DataFrame:
    """Rows without a code get ``<district>_<n>``; ``n`` runs from ``first`` in the
    order (name nulls first, original row) and restarts after ``last``.  A missing
    district prints as ``NA``; equal names get different numbers."""
    span = last - first + 1
    missing = df.filter(col(code_col).isNull())
    have = df.filter(col(code_col).isNotNull())
    ranked = global_rank(missing, [name_col, ord_col], "_rn", num_partitions)
    numbered = ranked.withColumn(
        code_col, paste(col(district_col), "_", (F.lit(first) + (F.col("_rn") - 1) % span).cast("long"))
    ).drop("_rn")
    return have.unionByName(numbered.select(*[col(c) for c in df.columns]))


def used_numbers(codes: DataFrame, code_col: str) -> DataFrame:
    """(district, n): the numbers that codes such as ``<district>_<n>`` or ``<district>-<n>`` hold, each once."""
    code = col(code_col)
    return codes.select(F.regexp_extract(code, CODE_PATTERN, 1).alias("_district"),
                        F.regexp_extract(code, CODE_PATTERN, 2).try_cast("long").alias("_n")) \
        .filter(F.col("_n").isNotNull()).distinct()


def free_ranges(used: DataFrame, districts: DataFrame, first: int, last: int) -> DataFrame:
    """(district, start, end, before): the gaps between used numbers, with the free numbers before each.

    The used numbers and two guards are sorted per district (at most ``last - first + 3`` rows),
    and what lies between neighbours is free: a row per gap, however wide."""
    inside = used.join(districts, "_district", "left_semi").filter(F.col("_n").between(first, last))
    guards = districts.select("_district", F.explode(F.array(F.lit(first - 1), F.lit(last + 1)).cast("array<long>")).alias("_n"))
    order = Window.partitionBy("_district").orderBy("_n")
    gaps = inside.unionByName(guards).withColumn("_next", F.lead("_n").over(order)) \
        .select("_district", (F.col("_n") + 1).alias("start"), (F.col("_next") - 1).alias("end")).filter("end >= start")
    so_far = Window.partitionBy("_district").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return gaps.withColumn("before", F.coalesce(F.sum(F.col("end") - F.col("start") + 1).over(so_far), F.lit(0)))


def assign_free_codes(df: DataFrame, held: DataFrame, code_col: str, name_col: str, district_col: str, ord_col: str,
                      first: int = FIRST_SITE_NUMBER, last: int = LAST_SITE_NUMBER,
                      num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """N2 over runs: rows without a code get the lowest numbers that their district has free.

    ``held`` has the codes given out before (a master's ``code_col``); codes in ``df`` count too.  Within a
    district sites are taken in the order of N2 (name, nulls first, then original row).  A district whose
    numbers run out leaves the last of its sites without a code: never a code twice.

    Returns (rows with codes, report): the report has a row per district with too few free numbers: (district, n_sites,
    n_free, n_without_code).

    Numbers are matched by (district, place): places come from one global rank, free numbers from the gaps
    between used ones, expanded only as far as there are sites - no district is sorted whole
    in one task."""
    district = F.coalesce(col(district_col).cast("string"), F.lit("NA"))
    missing = df.filter(col(code_col).isNull()).withColumn("_district", district)
    ranked = global_rank(missing, ["_district", name_col, ord_col], "_rn", num_partitions)
    need = materialize(ranked.groupBy("_district").agg((F.min("_rn") - 1).alias("_before"), F.count(F.lit(1)).alias("n_sites")))
    used = used_numbers(held.select(col(code_col).alias(code_col)).unionByName(df.select(col(code_col).alias(code_col)).filter(col(code_col).isNotNull())), code_col)
    gaps = free_ranges(used, need.select("_district"), first, last).join(need.select("_district", "n_sites"), "_district")
    left = F.col("n_sites") - F.col("before")
    numbers = gaps.filter(left > 0).select(
        "_district", "before", F.posexplode(F.sequence("start", F.least(F.col("end"), F.col("start") + left - 1))).alias("_i", "_number")) \
        .select("_district", (F.col("before") + F.col("_i") + 1).alias("_k"), "_number")
    placed = ranked.join(need.select("_district", "_before"), "_district").withColumn("_k", F.col("_rn") - F.col("_before"))
    coded = placed.join(numbers, ["_district", "_k"], "left") \
        .withColumn(code_col, F.when(F.col("_number").isNotNull(), paste(F.col("_district"), "_", F.col("_number"))))
    out = df.filter(col(code_col).isNotNull()).unionByName(coded.select(*[col(c) for c in df.columns]))
    free = gaps.groupBy("_district").agg(F.sum(F.col("end") - F.col("start") + 1).alias("n_free"))
    report = need.join(free, "_district", "left").select(
        F.col("_district").alias("district"), "n_sites", F.coalesce("n_free", F.lit(0)).alias("n_free")) \
        .withColumn("n_without_code", F.col("n_sites") - F.col("n_free")).filter("n_without_code > 0")
    return out, report


def dashed_code(c) -> Column:
    """first ``_`` of a code becomes ``-``."""
    return replace_first(c, "_", "-")


def final_code(master: str, own: str) -> Column:
    """E5: the master-list code wins when present."""
    return F.coalesce(col(master), col(own))
