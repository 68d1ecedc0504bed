"""Tests and intervals of analysis plans, bound to the driver's tables, beside their DuckDB SQL.

Neither engine's functions compute the other's: the SQL sums the series of the incomplete
gamma and beta functions with its own ``lgamma``, and takes variances from residuals row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from formsieve.plans import hypotheses, weighted
from formsieve.plans.catalog import PLAN_NUMERIC, PLAN_REPEAT, PLAN_SHARES, _lineitem_suppliers, _round, _rounded
from formsieve.plans.oracle import LS, Z


def _plan_row(dep: str, kind: str, ind: str, rep: str | None = None) -> dict:
    return {"Indicator": dep, "dependent.variable": dep, "dependent.variable.type": kind, "independent.variable": ind,
            "independent.variable.type": "categorical", "repeat.for.variable": rep, "hypothesis.type": "group_difference"}


# Two groups (Welch's t-test), many groups, a repeat variable, an answer that is the group itself.
TEST_PLAN = PLAN_SHARES + PLAN_REPEAT + PLAN_NUMERIC + [
    _plan_row("l_quantity", "numerical", "l_linestatus"), _plan_row("l_tax", "numerical", "l_returnflag", "l_linestatus"),
    _plan_row("l_linestatus", "categorical", "l_returnflag"), _plan_row("l_linestatus", "categorical", "l_linestatus", "l_linestatus")]


def plan_tests(spark: SparkSession, sf: str) -> DataFrame:
    """Chi-square and Welch tests of every plan row from one aggregate."""
    t = hypotheses.plan_tests(_lineitem_suppliers(spark, sf), TEST_PLAN)
    return t.withColumns({"statistic": _round("statistic"), "df2": _round("df2"), "p.value": _round("`p.value`")})


_RESULT = """'{dep}' AS "dependent.var", '{ind}' AS "independent.var", {rep} AS "repeat.var", r AS "repeat.var.value\""""


def _cells(dep: str, ind: str, rep: str | None) -> str:
    return (f"SELECT CAST({rep or 'NULL'} AS VARCHAR) AS r, CAST({ind} AS VARCHAR) AS g, {dep} AS v FROM ls "
            f"WHERE {dep} IS NOT NULL AND {ind} IS NOT NULL" + (f" AND {rep} IS NOT NULL" if rep else ""))


def _lower_series(lead: str, term: str) -> str:
    return f"list_sum([exp({lead} + {term}) FOR i IN range(0, 3000)])"


def _chi_square_sql(dep: str, ind: str, rep: str | None) -> str:
    names = _RESULT.format(dep=dep, ind=ind, rep=f"'{rep}'" if rep else "NULL::VARCHAR")
    # P(a, x) = sum of x^(a + i) e^-x / Gamma(a + i + 1)
    p = _lower_series("0", "(df1 / 2 + i) * ln(x / 2) - x / 2 - lgamma(df1 / 2 + i + 1)")
    return f"""(WITH d AS ({_cells(dep, ind, rep)}),
gs AS (SELECT r, g, count(*) AS n FROM d GROUP BY ALL), vs AS (SELECT r, v, count(*) AS n FROM d GROUP BY ALL), ts AS (SELECT r, count(*) AS n FROM d GROUP BY ALL),
o AS (SELECT r, g, v, count(*) AS n FROM d GROUP BY ALL),
e AS (SELECT gs.r, gs.g, vs.v, gs.n * vs.n / ts.n::DOUBLE AS e, ts.n FROM gs JOIN vs ON gs.r IS NOT DISTINCT FROM vs.r JOIN ts ON ts.r IS NOT DISTINCT FROM gs.r),
t AS (SELECT e.r, max(e.n) AS n, CAST((count(DISTINCT e.g) - 1) * (count(DISTINCT e.v) - 1) AS DOUBLE) AS df1, sum((coalesce(o.n, 0) - e) ** 2 / e) AS x
      FROM e LEFT JOIN o ON e.r IS NOT DISTINCT FROM o.r AND e.g = o.g AND e.v = o.v GROUP BY e.r)
SELECT {names}, 'chi-square' AS test, n, CASE WHEN df1 > 0 THEN round_even(x, 6) END AS statistic, CASE WHEN df1 > 0 THEN df1 END AS df1, NULL::DOUBLE AS df2,
       CASE WHEN df1 > 0 THEN round_even(1 - {p}, 6) END AS "p.value" FROM t)"""


def _welch_sql(dep: str, ind: str, rep: str | None) -> str:
    names = _RESULT.format(dep=dep, ind=ind, rep=f"'{rep}'" if rep else "NULL::VARCHAR")
    # I_y(b, a) with y = d1 F / (d2 + d1 F), b = d1 / 2, a = d2 / 2: y^b (1-y)^a / (b B(a, b)) * sum of (a+b)_i / (b+1)_i y^i
    a, b, y = "(d2 / 2)", "(d1 / 2)", "(d1 * f / (d2 + d1 * f))"
    lower = _lower_series(f"{b} * ln{y} + {a} * ln(1 - {y}) - lgamma({a}) - lgamma({b})", f"lgamma({a} + {b} + i) - lgamma({b} + 1 + i) + lgamma({b}) + i * ln{y}")
    return f"""(WITH d AS ({_cells(dep, ind, rep)}),
m AS (SELECT r, g, count(*) AS n, avg(v) AS m, count(*) / var_samp(v) AS w FROM d GROUP BY ALL),
t AS (SELECT r, sum(w) AS tw, sum(w * m) / sum(w) AS mean, count(*) AS k, sum(n) AS n FROM m GROUP BY r),
s AS (SELECT m.r, max(k)::DOUBLE AS k, max(t.n) AS n, sum(w * (m - mean) ** 2) AS a, sum((1 - w / tw) ** 2 / (m.n - 1)) AS l
      FROM m JOIN t ON m.r IS NOT DISTINCT FROM t.r GROUP BY m.r),
f AS (SELECT r, CAST(n AS BIGINT) AS n, k - 1 AS d1, (k * k - 1) / (3 * l) AS d2, a / (k - 1) / (1 + 2 * (k - 2) * l / (k * k - 1)) AS f FROM s)
SELECT {names}, 'welch' AS test, n, round_even(f, 6) AS statistic, d1 AS df1, round_even(d2, 6) AS df2, round_even(1 - {lower}, 6) AS "p.value" FROM f)"""


def _test_sql(row: dict) -> str:
    kind = _welch_sql if row["dependent.variable.type"] == "numerical" else _chi_square_sql
    return kind(row["dependent.variable"], row["independent.variable"], row["repeat.for.variable"])


PLAN_TESTS = f"WITH ls AS ({LS})\n" + "\nUNION ALL ".join(f"SELECT * FROM {_test_sql(r)}" for r in TEST_PLAN)


# ------------------------------------------------------------------ weights and strata

WEIGHTED_PLAN = [_plan_row("l_linestatus", "categorical", "l_returnflag"), _plan_row("l_linenumber", "categorical", "l_returnflag", "l_linestatus"),
                 _plan_row("l_extendedprice", "numerical", "l_returnflag")]


def plan_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Shares and means weighted by quantity, with the standard errors of a sample
    stratified by supplier nation."""
    return _rounded(weighted.run_weighted_plan(_lineitem_suppliers(spark, sf), WEIGHTED_PLAN, "l_quantity", "s_nationkey", sample_correction=True))


def _interval_sql(dep: str, kind: str, ind: str, rep: str | None) -> str:
    share = kind == "categorical"
    answers = "SELECT DISTINCT r, g, v AS val FROM d" if share else "SELECT DISTINCT r, g, NULL::VARCHAR AS val FROM d"
    value = "CASE WHEN d.v = a.val THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" if share else "CAST(d.v AS DOUBLE)"
    lo, hi = f"p - {Z} * se", f"p + {Z} * se"
    if share:
        lo, hi = f"greatest(0.0::DOUBLE, {lo})", f"least(1.0::DOUBLE, {hi})"
    v = f"CAST({dep} AS VARCHAR)" if share else dep
    return f"""(WITH d AS (SELECT CAST({rep or 'NULL'} AS VARCHAR) AS r, CAST({ind} AS VARCHAR) AS g, {v} AS v, l_quantity AS w, s_nationkey AS h FROM ls
                     WHERE {dep} IS NOT NULL AND {ind} IS NOT NULL AND l_quantity > 0),
a AS ({answers}),
p AS (SELECT a.r, a.g, a.val, sum(w * {value}) / sum(w) AS p, sum(w) AS tw FROM a JOIN d ON a.r IS NOT DISTINCT FROM d.r AND a.g = d.g GROUP BY ALL),
z AS (SELECT a.r, a.g, a.val, p, d.h, CASE WHEN d.g = a.g THEN w * ({value} - p) / tw ELSE 0.0::DOUBLE END AS z FROM p a JOIN d ON a.r IS NOT DISTINCT FROM d.r),
s AS (SELECT r, g, val, p, CASE WHEN count(*) > 1 THEN count(*) * var_samp(z) ELSE 0 END AS v FROM z GROUP BY r, g, val, p, h),
e AS (SELECT r, g, val, p, sqrt(sum(v)) AS se FROM s GROUP BY ALL)
SELECT '{dep}' AS "dependent.var", val AS "dependent.var.value", '{ind}' AS "independent.var", g AS "independent.var.value", round_even(p, 6) AS numbers,
       round_even(se, 6) AS se, round_even({lo}, 6) AS min, round_even({hi}, 6) AS max, {f"'{rep}'" if rep else "NULL::VARCHAR"} AS "repeat.var",
       r AS "repeat.var.value", {str(share).lower()} AS is_percent FROM e)"""


PLAN_INTERVALS = f"WITH ls AS ({LS})\n" + "\nUNION ALL ".join(
    f"SELECT * FROM {_interval_sql(r['dependent.variable'], r['dependent.variable.type'], r['independent.variable'], r['repeat.for.variable'])}" for r in WEIGHTED_PLAN)


QUERIES = {f.__name__: f for f in (plan_tests, plan_intervals)}
ORACLE_SQL = {"plan_tests": PLAN_TESTS, "plan_intervals": PLAN_INTERVALS}
