"""Analysis plans.

A plan is metadata: a few dozen rows naming a grouping column and dependent columns.
The plan rows are read on the driver (bounded by the plan, not the data) and turned
into one scan for all plan rows: each plan row becomes a struct per data row,
exploded in the scan's codegen stage and counted with one partial aggregate - all
indicators in one scan and one small shuffle, instead of one pass per indicator.
Totals are windows over the aggregated counts.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formsieve.functions.nulls import col, num_to_text
from formsieve.functions.text import to_number

# The long result layout.
RESULT_COLUMNS = ["dependent.var", "dependent.var.value", "independent.var", "independent.var.value",
                  "numbers", "se", "min", "max", "repeat.var", "repeat.var.value"]

# Decision: a normal-approximation interval, 95 % (z = 1.96), clipped to [0, 1] for shares.
Z_95 = 1.959963984540054


@dataclass(frozen=True)
class PlanRow:
    dependent: str
    dependent_type: str = "categorical"
    independent: str | None = None
    independent_type: str | None = "categorical"
    repeat: str | None = None
    hypothesis_type: str = "direct_reporting"
    indicator: str | None = None


def _blank(v) -> bool:
    return v is None or (isinstance(v, float) and math.isnan(v)) or str(v).strip() in ("", "NA")


def plan_rows(plan) -> list[PlanRow]:
    """Plan rows from a plan ``DataFrame`` (metadata, a few dozen rows) or dicts."""
    if isinstance(plan, DataFrame):
        recs = [r.asDict() for r in plan.collect()]
    else:
        recs = [dict(r) if not isinstance(r, PlanRow) else r for r in plan]
    out = []
    for r in recs:
        if isinstance(r, PlanRow):
            out.append(r)
            continue
        out.append(PlanRow(
            dependent=str(r["dependent.variable"]).strip(),
            dependent_type=str(r.get("dependent.variable.type") or "categorical").strip(),
            independent=None if _blank(r.get("independent.variable")) else str(r["independent.variable"]).strip(),
            independent_type=None if _blank(r.get("independent.variable.type")) else str(r["independent.variable.type"]).strip(),
            repeat=None if _blank(r.get("repeat.for.variable")) else str(r["repeat.for.variable"]).strip(),
            hypothesis_type=str(r.get("hypothesis.type") or "direct_reporting").strip(),
            indicator=r.get("Indicator"),
        ))
    return out


def _resolve(df: DataFrame, name: str | None) -> str | None:
    """Column names resolve ignoring case (the plan and the scripts differ in case)."""
    if name is None:
        return None
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    return None


def _value_text(df: DataFrame, c: str):
    return num_to_text(c, df.schema[c].dataType)


def plan_cells(df: DataFrame, cat_rows: Sequence[tuple[str, str | None, str | None]],
               num_rows: Sequence[tuple[str, str | None, str | None]] = (), also: Mapping[str, Column] | None = None):
    """The present answers of every plan row as rows, and the plan rows by number.

    Each plan row ``(dependent, independent, repeat)`` gets a number; per data row it
    yields one struct (row number, repeat value, group value, and the answer for a
    categorical row or the number for a numerical one), kept when the value and the
    group are present.  The structs are exploded inside the scan's stage.  ``also`` names
    further columns that every struct carries (a weight, a stratum)."""
    def text(c):
        return _value_text(df, c) if c else F.lit(None).cast("string")

    specs = [("c", *r) for r in dict.fromkeys(map(tuple, cat_rows))] + \
            [("n", *r) for r in dict.fromkeys(map(tuple, num_rows))]
    has_num = any(k == "n" for k, *_ in specs)
    # A group or repeat column every plan row needs: rows where it is null count
    # nowhere, so they are dropped before the unpivot (the test reaches the scan).
    needed = set.intersection(*[{c for c in (ind, rep) if c} for _, _, ind, rep in specs]) if specs else set()
    for c in sorted(needed):
        df = df.filter(col(c).isNotNull())
    entries = []
    for i, (kind, dep, ind, rep) in enumerate(specs):
        fields = [F.lit(i).alias("id"), F.lit(bool(rep)).alias("nr"), text(rep).alias("r"),
                  F.lit(bool(ind)).alias("ng"), text(ind).alias("g"),
                  (text(dep) if kind == "c" else F.lit(None).cast("string")).alias("val")]
        if has_num:
            fields.append((to_number(dep) if kind == "n" else F.lit(None).cast("double")).alias("x"))
        entries.append(F.struct(*fields, *[v.alias(k) for k, v in (also or {}).items()]))
    # a plain array of structs (never null) exploded in the scan's codegen stage; the
    # filter keeps present answers / numbers within present groups
    long = df.select(F.inline(F.array(*entries)))
    present = F.col("val").isNotNull() | (F.col("x").isNotNull() if has_num else F.lit(False))
    return long.filter(present & (~F.col("ng") | F.col("g").isNotNull()) & (~F.col("nr") | F.col("r").isNotNull())), specs


def plan_meta(specs, id_col: str = "id") -> Column:
    """The names of a plan row by its number: a literal array lookup on aggregated rows."""
    return F.element_at(F.array(*[F.struct(F.lit(k == "c").alias("share"), F.lit(rep).cast("string").alias("rv"),
                                           F.lit(ind).cast("string").alias("gv"), F.lit(dep).alias("var"))
                                  for k, dep, ind, rep in specs]), F.col(id_col) + 1)


def plan_rows_results(df: DataFrame, cat_rows: Sequence[tuple[str, str | None, str | None]],
                      num_rows: Sequence[tuple[str, str | None, str | None]] = ()) -> DataFrame:
    """D8 + D9 (+ D10, D17, N5) for many plan rows, categorical and numerical, in ONE
    scan and ONE partial aggregate.

    The present answers (:func:`plan_cells`) are reduced by one
    partial aggregate keyed by (row number, repeat value, group value, answer): a count,
    plus mean and sample sd of the number when the plan has numerical rows.  Only then
    are the row numbers mapped back to their names.  A categorical share divides by the total per plan row and group - a window
    over the aggregated counts; a numerical row is its group's mean, ``se = sd/sqrt(n)``.
    Output: :data:`RESULT_COLUMNS` + ``is_percent``."""
    long, specs = plan_cells(df, cat_rows, num_rows)
    has_num = any(k == "n" for k, *_ in specs)
    has_cat = any(k == "c" for k, *_ in specs)
    aggs = [F.count(F.lit(1)).alias("_n")]
    if has_num:
        aggs += [F.avg("x").alias("_m"), F.stddev_samp("x").alias("_sd")]
    counts = long.groupBy("id", "r", "g", "val").agg(*aggs)
    if has_cat:
        # the total per plan row and group is a window over the aggregated counts: a
        # window partition holds one group's distinct answers, never raw rows
        counts = counts.withColumn("_total", F.sum("_n").over(Window.partitionBy("id", "r", "g")))
    meta = plan_meta(specs)
    share = meta["share"]
    p = F.col("_n") / F.col("_total")
    se_p = F.sqrt(p * (F.lit(1) - p) / F.col("_total"))
    lo_p, hi_p = F.greatest(F.lit(0.0), p - F.lit(Z_95) * se_p), F.least(F.lit(1.0), p + F.lit(Z_95) * se_p)
    if has_num:
        m, se_m = F.col("_m"), F.col("_sd") / F.sqrt(F.col("_n"))
        lo_m, hi_m = m - F.lit(Z_95) * se_m, m + F.lit(Z_95) * se_m
    if has_cat and has_num:
        numbers, se, lo, hi = (F.when(share, a).otherwise(b) for a, b in ((p, m), (se_p, se_m), (lo_p, lo_m), (hi_p, hi_m)))
    elif has_cat:
        numbers, se, lo, hi = p, se_p, lo_p, hi_p
    else:
        numbers, se, lo, hi = m, se_m, lo_m, hi_m
    return counts.select(
        meta["var"].alias("dependent.var"), F.col("val").alias("dependent.var.value"),
        meta["gv"].alias("independent.var"), F.col("g").alias("independent.var.value"),
        numbers.alias("numbers"), se.alias("se"), lo.alias("min"), hi.alias("max"),
        meta["rv"].alias("repeat.var"), F.col("r").alias("repeat.var.value"),
        share.alias("is_percent"))


def categorical_rows_shares(df: DataFrame, rows: Sequence[tuple[str, str | None, str | None]]) -> DataFrame:
    """D8 for many categorical plan rows in one scan (see :func:`plan_rows_results`)."""
    return plan_rows_results(df, rows).drop("is_percent")


def categorical_shares(df: DataFrame, dependents: Sequence[str], independent: str | None = None,
                       repeat: str | None = None) -> DataFrame:
    """Shares of each answer of each dependent column within each group."""
    return categorical_rows_shares(df, [(d, independent, repeat) for d in dependents])


def numeric_means(df: DataFrame, dependents: Sequence[str], independent: str | None = None,
                  repeat: str | None = None) -> DataFrame:
    """D9 (+ D10): mean per group with a normal interval (``se = sd / sqrt(n)``)."""
    keys, sel = [], []
    if repeat:
        sel.append(_value_text(df, repeat).alias("_r"))
        keys.append("_r")
    if independent:
        sel.append(_value_text(df, independent).alias("_g"))
        keys.append("_g")
    sel += [to_number(d).alias(d) for d in dependents]
    long = df.select(*sel).unpivot(keys, list(dependents), "_var", "_val").filter(F.col("_val").isNotNull())
    for k in keys:
        long = long.filter(F.col(k).isNotNull())
    agg = long.groupBy(*keys, "_var").agg(F.avg("_val").alias("_m"), F.stddev_samp("_val").alias("_sd"),
                                          F.count(F.lit(1)).alias("_n"))
    se = F.col("_sd") / F.sqrt(F.col("_n"))
    return agg.select(
        F.col("_var").alias("dependent.var"), F.lit(None).cast("string").alias("dependent.var.value"),
        F.lit(independent).cast("string").alias("independent.var"),
        (F.col("_g") if independent else F.lit(None).cast("string")).alias("independent.var.value"),
        F.col("_m").alias("numbers"), se.alias("se"),
        (F.col("_m") - F.lit(Z_95) * se).alias("min"), (F.col("_m") + F.lit(Z_95) * se).alias("max"),
        F.lit(repeat).cast("string").alias("repeat.var"),
        (F.col("_r") if repeat else F.lit(None).cast("string")).alias("repeat.var.value"))


def plan_variables(df: DataFrame, plan, report: list | None = None) -> tuple[list[tuple], list[tuple]]:
    """(categorical, numerical) plan rows as (dependent, independent, repeat) of existing columns.

    Plan rows naming absent columns are skipped and listed in ``report`` (B13)."""
    buckets: dict[tuple, list[str]] = {}
    for r in plan_rows(plan):
        dep = _resolve(df, r.dependent)
        ind = _resolve(df, r.independent) if r.independent else None
        rep = _resolve(df, r.repeat) if r.repeat else None
        if dep is None or (r.independent and ind is None) or (r.repeat and rep is None):
            if report is not None:
                report.append({"dependent.variable": r.dependent, "reason": "column absent"})
            continue
        kind = "numerical" if r.dependent_type.lower() in ("numerical", "numeric") else "categorical"
        deps = buckets.setdefault((ind, rep, kind), [])
        if dep not in deps:
            deps.append(dep)
    cat_rows = [(d, ind, rep) for (ind, rep, kind), deps in buckets.items() if kind == "categorical" for d in deps]
    num_rows = [(d, ind, rep) for (ind, rep, kind), deps in buckets.items() if kind == "numerical" for d in deps]
    if not cat_rows and not num_rows:
        raise ValueError("no plan row names an existing column")
    return cat_rows, num_rows


def run_plan(df: DataFrame, plan, report: list | None = None) -> DataFrame:
    """Every plan row, categorical or numerical, in one scan and one shuffle.

    Plan rows naming absent columns are skipped and listed in ``report`` (B13)."""
    return plan_rows_results(df, *plan_variables(df, plan, report))


# ---------------------------------------------------------------- D16 automatic plan

CATEGORICAL_TYPES = ("select_one", "select_multiple")
NUMERIC_TYPES = ("integer", "decimal", "calculate", "numeric", "range")


def column_types(df: DataFrame, questions: Mapping[str, str] | None = None) -> dict[str, str]:
    """D16 ``map_to_datatypes``: categorical / sm_choice / numerical / text per column.

    From the question table when given (``name -> type``), else from the schema."""
    out = {}
    qtypes = {k.lower(): v for k, v in (questions or {}).items()}
    sm_questions = {k for k, v in qtypes.items() if str(v).startswith("select_multiple")}
    for f in df.schema.fields:
        name = f.name.lower()
        if qtypes:
            t = str(qtypes.get(name, "")).split(" ")[0]
            if "." in name and name.split(".", 1)[0] in sm_questions:
                out[f.name] = "sm_choice"
            elif t in CATEGORICAL_TYPES:
                out[f.name] = "categorical"
            elif t in NUMERIC_TYPES:
                out[f.name] = "numerical"
            elif t == "text":
                out[f.name] = "text"
            continue
        if isinstance(f.dataType, (T.StringType, T.BooleanType)):
            out[f.name] = "categorical"
        elif isinstance(f.dataType, T.NumericType):
            out[f.name] = "numerical"
    return out


def auto_plan(df: DataFrame, questions: Mapping[str, str] | None = None, independent: str | None = None,
              repeat: str | None = None, exclude: Sequence[str] = ()) -> list[PlanRow]:
    """D16 ``make_analysisplan_all_vars``: one direct-reporting row per categorical or
    numerical column; the grouping column must be categorical."""
    types = column_types(df, questions)
    if independent is not None and types.get(independent) != "categorical":
        raise ValueError("independent variable must be categorical")
    skip = set(exclude) | {independent, repeat}
    return [PlanRow(dependent=c, dependent_type=t, independent=independent, repeat=repeat)
            for c, t in types.items() if t in ("categorical", "numerical") and c not in skip]


# ---------------------------------------------------------------- D18, J14, W7

def label_results(results: DataFrame, dictionary: DataFrame, question_lists: DataFrame | None = None,
                  value_col: str = "dependent.var.value", out_col: str = "dependent.var.value.label") -> DataFrame:
    """D18 ``map_to_labeled``: answer codes to labels, first match per code - scoped to
    the question's choice list when ``question_lists`` (name, list_name) is given."""
    from formsieve.operators.lookup import first_per_code
    if question_lists is None:
        d = first_per_code(dictionary).select(F.col("name").alias("_code"), F.col("label_english").alias(out_col))
        return results.join(d, col(value_col) == F.col("_code"), "left").drop("_code")
    d = first_per_code(dictionary, scope=["list_name"]).select(
        F.col("list_name").alias("_list"), F.col("name").alias("_code"), F.col("label_english").alias(out_col))
    q = question_lists.select(F.col("name").alias("_q"), F.col("list_name").alias("_list"))
    r = results.join(q, col("dependent.var") == F.col("_q"), "left").withColumnRenamed("_list", "_qlist")
    j = r.join(d, (F.col("_qlist") == F.col("_list")) & (col(value_col) == F.col("_code")), "left")
    return j.drop("_q", "_qlist", "_list", "_code")


def collapsed_labels(labelled: DataFrame, keys: Sequence[str], label_col: str) -> DataFrame:
    """The warning case of D18: keys whose labels make two results indistinguishable."""
    return labelled.groupBy(*[col(k) for k in keys], col(label_col)).agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") > 1)


def results_subset(results: DataFrame, repeat_vars: Sequence[str] | None = None,
                   repeat_values: Sequence[str] | None = None, dependent_vars: Sequence[str] | None = None,
                   mask: str | None = None) -> DataFrame:
    """Keep results matching all given conditions."""
    cond = F.lit(True)
    if mask is not None:
        cond = cond & F.coalesce(col(mask), F.lit(False))
    if repeat_vars is not None:
        cond = cond & F.coalesce(col("repeat.var").isin(list(repeat_vars)), F.lit(False))
    if repeat_values is not None:
        cond = cond & F.coalesce(col("repeat.var.value").isin(list(repeat_values)), F.lit(False))
    if dependent_vars is not None:
        cond = cond & F.coalesce(col("dependent.var").isin(list(dependent_vars)), F.lit(False))
    return results.filter(cond)


def labelled_with_report(results: DataFrame, dictionary: DataFrame, question_lists: DataFrame | None = None,
                         value_col: str = "dependent.var.value", out_col: str = "dependent.var.value.label") -> tuple[DataFrame, DataFrame]:
    """D18 with its warning: (labelled results, the labels that stand for several results of one analysis).

    Warns if there are any; one small job over the aggregated results finds out."""
    labelled = label_results(results, dictionary, question_lists, value_col, out_col)
    keys = ["dependent.var", "independent.var", "independent.var.value", "repeat.var", "repeat.var.value"]
    collapsed = collapsed_labels(labelled.filter(col(out_col).isNotNull()), [k for k in keys if k in labelled.columns], out_col)
    if not collapsed.isEmpty():
        warnings.warn("labelling made some analysis definitions indistinguishable")
    return labelled, collapsed
