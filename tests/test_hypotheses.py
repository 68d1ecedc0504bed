"""P-values of plans (J14) and intervals of weighted, stratified plans (D10) against brute force."""

import math
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from formsieve.functions.special import beta_tail, chi_square_p, f_p, gamma_q, log_gamma
from formsieve.plans import analysis, hypotheses, weighted


def brute_q(a, x):
    """Q(a, x) from the series of P(a, x), run until it stands still."""
    term = total = 1.0
    for n in range(1, 200_000):
        term *= x / (a + n)
        total += term
        if term < total * 1e-18:
            break
    return 1 - math.exp(a * math.log(x) - x - math.lgamma(a + 1)) * total


def simpson(f, lo, hi, n=20_000):
    h = (hi - lo) / n
    return h / 3 * math.fsum(f(lo + i * h) * (1 if i in (0, n) else 4 if i % 2 else 2) for i in range(n + 1))


def brute_f(x, d1, d2):
    """P(F > x): the beta integral by Simpson, over a variable that removes the poles at both ends."""
    a, b = d2 / 2, d1 / 2
    top = math.asin(math.sqrt(d2 / (d2 + d1 * x)))
    lead = 2 * math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b))
    return lead * simpson(lambda t: math.sin(t) ** (2 * a - 1) * math.cos(t) ** (2 * b - 1), 0, top)


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()


def test_log_gamma(spark):
    xs = [1e-3, 0.5, 1.0, 2.0, 3.7, 9.99, 10.0, 123.4, 1e6]
    got = one(spark, **{f"c{i}": log_gamma(x) for i, x in enumerate(xs)})
    for i, x in enumerate(xs):
        assert got[f"c{i}"] == pytest.approx(math.lgamma(x), rel=1e-13, abs=1e-13)


def test_chi_square_p(spark):
    cases = [(float(k), float(x)) for k in (1, 2, 3, 7, 24, 150, 999) for x in (0.01, 0.7, k * 0.5, k, k * 1.2, k + 30)]
    df = spark.createDataFrame(cases, "k double, x double").select("k", "x", chi_square_p(F.col("x"), F.col("k")).alias("p"))
    for k, x, p in df.collect():
        assert p == pytest.approx(brute_q(k / 2, x / 2), abs=1e-12)
        if k % 2 == 0:  # a finite sum, exactly
            exact = sum(Fraction(x / 2) ** i / math.factorial(i) for i in range(int(k) // 2))
            assert p == pytest.approx(float(exact) * math.exp(-x / 2), rel=1e-9)
    far = one(spark, a=chi_square_p(0.0, 5.0), b=chi_square_p(400.0, 2.0), c=gamma_q(1e6, 1e6), d=chi_square_p(1e5, 3.0))
    assert far["a"] == 1 and far["b"] == pytest.approx(math.exp(-200), rel=1e-10) and far["d"] == 0
    assert far["c"] == pytest.approx(0.5 - 1 / (3 * math.sqrt(2 * math.pi * 1e6)), abs=1e-10)


def test_f_p(spark):
    cases = [(d1, d2, x) for d1 in (1.0, 2.0, 5.0, 24.0) for d2 in (3.0, 7.5, 60.25, 900.0) for x in (0.2, 1.0, 2.5, 9.0)]
    df = spark.createDataFrame(cases, "d1 double, d2 double, x double").select("*", f_p(F.col("x"), F.col("d1"), F.col("d2")).alias("p"))
    for d1, d2, x, p in df.collect():
        assert p == pytest.approx(brute_f(x, d1, d2), abs=1e-10)
    # two degrees above: a power, exactly; a million degrees below: nearly chi-square
    got = one(spark, a=f_p(30.0, 2.0, 40.0), b=f_p(3.0, 1.0, 2e6), c=beta_tail(2.0, 3.0, 0.0), d=f_p(1e9, 1.0, 10.0))
    assert got["a"] == pytest.approx((1 + 60 / 40) ** -20, rel=1e-10)
    assert got["b"] == pytest.approx(math.erfc(math.sqrt(1.5)), rel=1e-5) and got["c"] == 1 and 0 <= got["d"] < 1e-30


def _survey(spark, n=700, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        g = rng.choice(["a", "b", "c", None])
        rows.append((g, rng.choice(["m", "f"]), rng.choice(["yes", "no", "no", None] if g != "c" else ["yes", "no"]),
                     None if rng.random() < 0.1 else round(rng.gauss(5 + (g == "b"), 1 + (g == "c")), 3), rng.choice([0.5, 1.0, 2.0, 3.5, None, -1.0]),
                     rng.choice(["s1", "s2", "s3", None]), "only", 4.0 if g == "a" else rng.random()))
    return rows, spark.createDataFrame(rows, "g string, sex string, ans string, x double, w double, s string, same string, flat double")


def _row(dep, kind, ind, rep=None):
    return {"dependent.variable": dep, "dependent.variable.type": kind, "independent.variable": ind, "independent.variable.type": "categorical",
            "repeat.for.variable": rep, "hypothesis.type": "group_difference", "Indicator": None}


PLAN = [_row("ans", "categorical", "g"), _row("ans", "categorical", "g", "sex"), _row("same", "categorical", "g"), _row("x", "numerical", "g"),
        _row("x", "numerical", "sex"), _row("x", "numerical", "same"), _row("flat", "numerical", "g"), _row("x", "numerical", "g", "sex"),
        _row("absent", "numerical", "g")]


def test_plan_tests(spark):
    rows, df = _survey(spark)
    report = []
    tests = hypotheses.plan_tests(df, PLAN, report)
    assert tests.columns == hypotheses.TEST_COLUMNS and len(report) == 1
    got = {(r["dependent.var"], r["independent.var"], r["repeat.var.value"]): r for r in tests.collect()}
    assert len(got) == 10
    index = {c: i for i, c in enumerate(df.columns)}
    for (dep, ind, rep), r in got.items():
        data = [(x[index[ind]], x[index[dep]]) for x in rows if x[index[ind]] is not None and x[index[dep]] is not None and (rep is None or x[1] == rep)]
        assert r["n"] == len(data)
        if r["test"] == hypotheses.CHI_SQUARE:
            count = defaultdict(int)
            for cell in data:
                count[cell] += 1
            gs, vs = {g for g, _ in data}, {v for _, v in data}
            if len(vs) < 2:
                assert r["statistic"] is None and r["p.value"] is None
                continue
            e = {(g, v): sum(c for (h, _), c in count.items() if h == g) * sum(c for (_, u), c in count.items() if u == v) / len(data) for g in gs for v in vs}
            x = sum((count[k] - e[k]) ** 2 / e[k] for k in e)
            assert r["df1"] == (len(gs) - 1) * (len(vs) - 1) and r["statistic"] == pytest.approx(x, rel=1e-10)
            assert r["p.value"] == pytest.approx(brute_q(r["df1"] / 2, x / 2), abs=1e-9)
        elif dep == "flat" or ind == "same":
            assert r["p.value"] is None and r["statistic"] is None
        else:
            by = defaultdict(list)
            for g, v in data:
                by[g].append(v)
            m = {g: math.fsum(v) / len(v) for g, v in by.items()}
            w = {g: len(v) * (len(v) - 1) / math.fsum((y - m[g]) ** 2 for y in v) for g, v in by.items()}
            k, total = len(by), sum(w.values())
            mean = sum(w[g] * m[g] for g in by) / total
            lam = sum((1 - w[g] / total) ** 2 / (len(by[g]) - 1) for g in by)
            f = sum(w[g] * (m[g] - mean) ** 2 for g in by) / (k - 1) / (1 + 2 * (k - 2) * lam / (k * k - 1))
            assert r["statistic"] == pytest.approx(f, rel=1e-9) and r["df2"] == pytest.approx((k * k - 1) / (3 * lam), rel=1e-9)
            assert r["p.value"] == pytest.approx(brute_f(f, k - 1, r["df2"]), abs=1e-9)
    results = analysis.run_plan(df, PLAN)
    with_p = hypotheses.attach_tests(results, tests)
    assert with_p.count() == results.count()
    for r in with_p.collect():
        p = got[r["dependent.var"], r["independent.var"], r["repeat.var.value"]]["p.value"]
        assert r["p.value"] is None if p is None else r["p.value"] == pytest.approx(p, rel=1e-9)


def test_a_cell_nobody_is_in_counts(spark):
    df = spark.createDataFrame([("a", "x")] * 8 + [("b", "y")] * 6 + [("b", "x")] * 2, "g string, v string")
    r = hypotheses.plan_tests(df, [_row("v", "categorical", "g")]).first()
    assert r["statistic"] == pytest.approx(16 * (8 * 6) ** 2 / (8 * 8 * 10 * 6))


def test_plan_tests_read_the_data_once(spark, tmp_path):
    """The cells are kept: neither tests nor intervals go back to the data, however many of its rows they compare."""
    _, df = _survey(spark)
    df.write.parquet(f"{tmp_path}/t")
    data = spark.read.parquet(f"{tmp_path}/t")
    for result in (hypotheses.plan_tests(data, PLAN[:5]), weighted.run_weighted_plan(data, PLAN[:5], "w", "s")):
        assert result.count() > 0
        assert "FileScan" not in result._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ weights and strata

def brute_intervals(rows, dep, ind, rep, share, weight, strata, corrected):
    index = {c: i for i, c in enumerate(["g", "sex", "ans", "x", "w", "s", "same", "flat"])}
    get = lambda x, c: x[index[c]] if c else None
    out = {}
    data = [(get(x, rep), get(x, ind), get(x, dep), get(x, weight) if weight else 1.0, get(x, strata)) for x in rows]
    data = [d for d in data if d[2] is not None and d[1] is not None and (rep is None or d[0] is not None) and d[3] is not None and d[3] > 0]
    for r in {d[0] for d in data}:
        sample = [d for d in data if d[0] == r]
        for g in {d[1] for d in sample}:
            for v in ({d[2] for d in sample if d[1] == g} if share else {None}):
                y = [(float(d[2] == v) if share else d[2]) for d in sample]
                total = math.fsum(d[3] for d in sample if d[1] == g)
                p = math.fsum(d[3] * t for d, t in zip(sample, y) if d[1] == g) / total
                z = [d[3] * (t - p) / total if d[1] == g else 0.0 for d, t in zip(sample, y)]
                var = 0.0
                for s in {d[4] for d in sample}:
                    part = [t for d, t in zip(sample, z) if d[4] == s]
                    mean = math.fsum(part) / len(part)
                    c = len(part) / (len(part) - 1) if corrected and len(part) > 1 else 1.0
                    var += c * math.fsum((t - mean) ** 2 for t in part)
                n = sum(d[1] == g for d in sample)
                out[r, g, v] = (p, math.sqrt(var * (1 if share or corrected else n / (n - 1))))
    return out


@pytest.mark.parametrize("weight,strata,corrected", [("w", "s", False), ("w", "s", True), ("w", None, False), (None, "s", True)])
def test_weighted_intervals(spark, weight, strata, corrected):
    rows, df = _survey(spark)
    plan = [_row("ans", "categorical", "g"), _row("ans", "categorical", "g", "sex"), _row("x", "numerical", "g"), _row("x", "numerical", "g", "sex")]
    res = weighted.run_weighted_plan(df, plan, weight, strata, corrected)
    assert res.columns == [*analysis.RESULT_COLUMNS, "is_percent"]
    seen = 0
    for dep, share in (("ans", True), ("x", False)):
        for rep in (None, "sex"):
            want = brute_intervals(rows, dep, "g", rep, share, weight, strata, corrected)
            got = {(r["repeat.var.value"], r["independent.var.value"], r["dependent.var.value"]): r for r in res.collect()
                   if r["dependent.var"] == dep and (r["repeat.var"] is not None) == (rep is not None)}
            assert set(got) == set(want)
            for k, (p, se) in want.items():
                assert got[k]["numbers"] == pytest.approx(p, rel=1e-10) and got[k]["se"] == pytest.approx(se, rel=1e-8, abs=1e-12)
                lo, hi = p - analysis.Z_95 * se, p + analysis.Z_95 * se
                assert got[k]["min"] == pytest.approx(max(0, lo) if share else lo) and got[k]["max"] == pytest.approx(min(1, hi) if share else hi)
                seen += 1
    assert seen > 15


def test_weights_of_one_give_the_plain_plan(spark):
    _, df = _survey(spark)
    plan = PLAN[:4] + PLAN[7:8]
    key = lambda r: tuple("" if r[c] is None else r[c] for c in ("dependent.var", "dependent.var.value", "independent.var.value", "repeat.var.value"))
    plain = {key(r): r for r in analysis.run_plan(df, plan).collect()}
    for w in (None, "one"):
        got = {key(r): r for r in weighted.run_weighted_plan(df.withColumn("one", F.lit(1)), plan, w).collect()}
        assert set(got) == set(plain)
        for k, r in got.items():
            for c in ("numbers", "se", "min", "max"):
                assert r[c] == pytest.approx(plain[k][c], rel=1e-9, abs=1e-9)


def test_weighted_means_far_from_zero(spark):
    rows = [("a", 1e9 + i % 3, 1.0 + i % 2) for i in range(90)]
    df = spark.createDataFrame(rows, "g string, x double, w double")
    r = weighted.run_weighted_plan(df, [_row("x", "numerical", "g")], "w").first()
    total = sum(w for *_, w in rows)
    m = sum((x - 1e9) * w for _, x, w in rows) / total
    var = sum((w * (x - 1e9 - m) / total) ** 2 for _, x, w in rows) * 90 / 89
    assert r["numbers"] == pytest.approx(1e9 + m, rel=1e-15) and r["se"] == pytest.approx(math.sqrt(var), rel=1e-9)
