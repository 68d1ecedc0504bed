"""Operators against plain-Python brute force on seeded random fixtures."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from formsieve.operators import aggregate as agg
from formsieve.operators import checks
from formsieve.operators.sitecodes import assign_site_codes
from formsieve.plans import analysis
from tests.fixtures import responses_df, make_responses, COLUMNS


def _round2(x):
    # half-even on the decimal text, as bround does
    from decimal import Decimal, ROUND_HALF_EVEN
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_EVEN))


def test_durations_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(300):
        d1 = f"2021-03-{rnd.randint(1, 3):02d}"
        d2 = d1 if rnd.random() < 0.8 else f"2021-03-{rnd.randint(1, 4):02d}"
        t = lambda: f"{rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:{rnd.randint(0, 59):02d}.{rnd.randint(0, 999):03d}+03:00"
        rows.append((f"u{i}", f"{d1}T{t()}", f"{d2}T{t()}"))
    df = spark.createDataFrame(rows, "uuid string, start string, end string")
    got = sorted((r.uuid, r.value, r.issue_type) for r in checks.duration_issues(df, 5, 40).collect())

    def minutes(text):
        h, m, s = text.split("T")[1][:8].split(":")
        return _round2(int(h) * 60 + int(m) + int(s) / 60)
    exp = []
    for u, s, e in rows:
        if s.split("T")[0] != e.split("T")[0]:
            continue
        dur = minutes(e) - minutes(s)
        if dur <= 5:
            exp.append((u, dur, checks.SHORT_ISSUE))
        if dur >= 40:
            exp.append((u, dur, checks.LONG_ISSUE))
    assert got == sorted(exp)


def test_outliers_brute_force(spark):
    rnd = random.Random(5)
    vals = [rnd.lognormvariate(3, 1) for _ in range(400)] + [None, 0.0, -2.0]
    df = spark.createDataFrame([(f"u{i}", v) for i, v in enumerate(vals)], "uuid string, x double")
    got = sorted((r.uuid, r.issue_type) for r in checks.outliers(df, "uuid", ["x"], k=2.5).collect())
    xs = [v for v in vals if v is not None]
    logs = [math.log(v) for v in xs if v > 0]

    def mean_sd(a):
        m = sum(a) / len(a)
        return m, math.sqrt(sum((v - m) ** 2 for v in a) / (len(a) - 1))
    m, sd = mean_sd(xs)
    ml, sl = mean_sd(logs)
    exp = []
    for i, v in enumerate(vals):
        if v is None:
            continue
        if abs(v - m) > 2.5 * sd:
            exp.append((f"u{i}", checks.OUTLIER_NORMAL))
        if v > 0 and abs(math.log(v) - ml) > 2.5 * sl:
            exp.append((f"u{i}", checks.OUTLIER_LOG))
    assert got == sorted(exp)


def test_plan_shares_brute_force(spark):
    data = [dict(zip(COLUMNS, r)) for r in make_responses(200, seed=11)]
    df = responses_df(spark, 200, seed=11)
    deps = ["c1_type_of_site", "b1_site_management", "c7_presence_of_particularly_vulnerable_groups.elderly"]
    res = analysis.categorical_shares(df, deps, "a1_governorate_name")
    got = {(r["dependent.var"], r["independent.var.value"], r["dependent.var.value"]): r["numbers"]
           for r in res.collect()}
    counts = defaultdict(Counter)
    for r in data:
        g = r["a1_governorate_name"]
        for d in deps:
            v = r[d]
            if v is not None and g is not None:
                counts[(d, g)][str(v)] += 1
    exp = {(d, g, v): n / sum(c.values()) for (d, g), c in counts.items() for v, n in c.items()}
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) < 1e-15 for k in exp)


@pytest.mark.parametrize("parts", [1, 5, 13])
def test_site_codes_brute_force(spark, parts):
    rnd = random.Random(parts)
    rows = [(i, None if rnd.random() < 0.7 else f"K{i}", rnd.choice(["b", "a", None, "c", "a "]),
             rnd.choice(["D1", "D2", None])) for i in range(500)]
    df = spark.createDataFrame(rows, "idx long, code string, name string, district string")
    got = dict(assign_site_codes(df, "code", "name", "district", "idx", first=10, last=109, num_partitions=parts)
               .select("idx", "code").collect())
    missing = sorted((r for r in rows if r[1] is None), key=lambda r: (r[2] is not None, r[2] or "", r[0]))
    exp = {r[0]: r[1] for r in rows if r[1] is not None}
    for pos, r in enumerate(missing):
        exp[r[0]] = f"{r[3] or 'NA'}_{10 + pos % 100}"
    assert got == exp


def test_multiple_response_by_prefix_brute_force(spark):
    data = [dict(zip(COLUMNS, r)) for r in make_responses(150, seed=13)]
    df = responses_df(spark, 150, seed=13)
    q = "f1_threats_to_the_site"
    out = {r.question: (r.freq, r.percent, r.percentofcases)
           for r in agg.multiple_response_by_prefix(df, q).collect()}
    opts = [c for c in COLUMNS if c.startswith(q + ".")]

    def strict(vals):
        return None if any(v is None for v in vals) else sum(vals)
    freqs = {o.split(".", 1)[1]: strict([None if r[o] is None else int(r[o] != 0) for r in data]) for o in opts}
    rowsum = [None if any(r[o] is None for o in opts) else sum(r[o] for o in opts) for r in data]
    cases = strict([None if s is None else int(s != 0) for s in rowsum])
    total = None if any(v is None for v in freqs.values()) else sum(freqs.values())
    for name, f in list(freqs.items()) + [("Total", total)]:
        got = out[name]
        if f is None:
            assert got[0] is None
        else:
            assert got[0] == float(f)
