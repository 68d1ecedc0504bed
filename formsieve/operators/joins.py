"""Dimension joins, anti/semi joins, join chains.

Every join is an equi-join on one key.  Dimensions are deduplicated first because
that changes row counts; whether a side is broadcast is left to the planner, which
uses file statistics and AQE runtime sizes (a checked size), and falls back to a
shuffle join otherwise.  AQE's skew-join split covers a hot key on the large side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formsieve.functions.nulls import col, join_on


def dimension(admin: DataFrame, code_col: str, name_col: str, out_code: str, out_name: str) -> DataFrame:
    """One deduplicated (code, name) dimension of an admin list."""
    return admin.select(col(name_col).alias(out_name), col(code_col).alias(out_code)).distinct()


def add_admin_names(df: DataFrame, admin: DataFrame, levels: Sequence[tuple[str, str, str, str]],
                    constants: Mapping[str, object] | None = None) -> DataFrame:
    """Left join each level's distinct (code, name) dimension on the data's code column.

    ``levels`` holds ``(admin_code_col, admin_name_col, data_code_col, out_name_col)``.
    A code with two names multiplies rows, as a left join does.  An existing column
    named like an output column is replaced (no ``.x`` / ``.y`` pairs)."""
    out = df
    for code_c, name_c, data_code, out_name in levels:
        dim = dimension(admin, code_c, name_c, data_code, out_name)
        if out_name in out.columns:
            out = out.drop(out_name)
        out = out.join(dim, data_code, "left")
    if constants:
        out = out.withColumns({k: F.lit(v) for k, v in constants.items()})
    return out


def new_rows_only(batch: DataFrame, master: DataFrame, key: str = "uuid") -> DataFrame:
    """Batch rows whose key is not in the master (left anti join)."""
    return batch.join(master.select(col(key)), key, "left_anti")


def rows_in(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows whose key is in ``other`` (left semi join)."""
    ok = other_key or key
    o = other.select(col(ok).alias("_m_key"))
    return df.join(o, df[key] == o["_m_key"], "left_semi")


def membership_flag(df: DataFrame, key: str, other: DataFrame, other_key: str | None = None,
                    out_col: str = "in_other") -> DataFrame:
    """``key %in% other_key`` as a boolean per row (null keys are FALSE, as ``%in%``)."""
    ok = other_key or key
    marks = other.select(col(ok).alias("_m_key")).distinct().withColumn("_m_hit", F.lit(True))
    j = df.join(marks, df[key] == marks["_m_key"], "left")
    return j.withColumn(out_col, F.coalesce(F.col("_m_hit"), F.lit(False))).drop("_m_key", "_m_hit")


def membership_report(df: DataFrame, key: str, other: DataFrame, other_key: str | None = None) -> DataFrame:
    """The distinct values of the membership vector, with counts."""
    flagged = membership_flag(df, key, other, other_key, "is_member")
    return flagged.groupBy("is_member").agg(F.count(F.lit(1)).alias("n_rows"))


def join_chain(frames: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """``join_all(type='left')`` - every match kept, so ties fan out."""
    return reduce(lambda a, b: join_on(a, b, key, "left"), frames)


def with_row_id(df: DataFrame, order_cols: Sequence[str], out_col: str = "row_id") -> DataFrame:
    """J11 support: a stable row id from a total order (see sitecodes.global_rank)."""
    from formsieve.operators.sitecodes import global_rank
    return global_rank(df, order_cols, out_col)


def attach_by_key(log: DataFrame, data: DataFrame, key: str, cols: Sequence[str], ord_col: str) -> DataFrame:
    """Attach columns of the data to a foreign log by key; first match by ``ord_col``
    (a partial aggregate, so a repeated key never lands whole in one task)."""
    firsts = data.groupBy(col(key)).agg(
        F.min_by(F.struct(*[col(c).alias(c) for c in cols]), col(ord_col)).alias("_first"))
    return log.join(firsts.select(key, "_first.*"), key, "left")


def attach_p_values(results: DataFrame, p_values: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """P-value per analysis; null when a test result is absent."""
    return join_on(results, p_values, key, "left")
