"""Distribution functions as native column expressions: incomplete gamma and beta.

Spark has no gamma function; these are built from its own arithmetic so that a test's
p-value is a column like any other.  Leading factors of large arguments come from
differences taken before rounding could matter (``log1p`` and Stirling's
correction), so accuracy doesn't fall with the number of rows behind a statistic.
Series and continued fractions run a number of steps that follows from the shape
parameters; they are meant for aggregated rows, one per test.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Steps of a series: its terms fall like exp(-n^2 / 2a), a continued fraction faster.
LEAST_STEPS, STEPS_PER_ROOT, MOST_STEPS = 200, 9, 1_000_000
#: Below this an argument is shifted up before Stirling's series.
SHIFT = 10
_TINY = 1e-300
_HALF_LOG_2PI = 0.5 * math.log(2 * math.pi)


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def _correction(z: Column) -> Column:
    """Stirling's series less its leading terms, for z >= 10."""
    r = F.lit(1.0) / (z * z)
    out = F.lit(-691.0 / 360360)
    for c in (1 / 1188, -1 / 1680, 1 / 1260, -1 / 360, 1 / 12):
        out = out * r + F.lit(c)
    return out / z


def log_gamma(x) -> Column:
    """ln Gamma(x) for x > 0."""
    x = _lit(x)
    z = F.when(x < SHIFT, x + SHIFT).otherwise(x)
    down = sum((F.log(x + F.lit(float(k))) for k in range(SHIFT)), F.lit(0.0))
    stirling = (z - 0.5) * F.log(z) - z + F.lit(_HALF_LOG_2PI) + _correction(z)
    return F.when(x < SHIFT, stirling - down).otherwise(stirling)


def _log_gamma_step(a: Column, b: Column) -> Column:
    """ln Gamma(a + b) - ln Gamma(a), without the difference of two large numbers."""
    large = F.greatest(a, F.lit(float(SHIFT)))  # the other branch is evaluated too: keep it finite
    far = b * F.log(large) + (large + b - 0.5) * F.log1p(b / large) - b + _correction(large + b) - _correction(large)
    return F.when(a < SHIFT, log_gamma(a + b) - log_gamma(a)).otherwise(far)


def _safe(x: Column) -> Column:
    return F.when(F.abs(x) < _TINY, F.lit(_TINY)).otherwise(x)


def _steps(shape: Column, state: Column, step, finish):
    n = F.least(F.lit(MOST_STEPS), LEAST_STEPS + F.ceil(STEPS_PER_ROOT * F.sqrt(shape)).cast("int"))
    return F.aggregate(F.sequence(F.lit(1), n), state, step, finish)


def gamma_q(a, x) -> Column:
    """Q(a, x), the upper regularised incomplete gamma function, for a > 0 and x >= 0."""
    a, x0 = _lit(a), _lit(x)
    x = F.greatest(x0, F.lit(_TINY))
    large = F.greatest(a, F.lit(float(SHIFT)))
    mu = (x - large) / large
    log_lead = F.when(a < SHIFT, a * F.log(x) - x - log_gamma(a)).otherwise(
        -large * (mu - F.log1p(F.greatest(mu, F.lit(-1 + 1e-16)))) + 0.5 * F.log(large) - F.lit(_HALF_LOG_2PI) - _correction(large))
    lead = F.exp(log_lead)  # x^a e^-x / Gamma(a)

    def term(s, i):
        t = s["t"] * x / (a + i)
        return F.struct(t.alias("t"), (s["sum"] + t).alias("sum"))

    lower = lead / a * _steps(a, F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("sum")), term, lambda s: s["sum"])

    def fraction(s, i):
        an, b = -i * (i - a), x + 1 - a + 2 * i
        d = F.lit(1.0) / _safe(an * s["d"] + b)
        c = _safe(b + an / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))

    first = F.lit(1.0) / _safe(x + 1 - a)
    upper = lead * _steps(a, F.struct(F.lit(1 / _TINY).alias("c"), first.alias("d"), first.alias("h")), fraction, lambda s: s["h"])
    return F.when(x0 <= 0, F.lit(1.0)).when(x < a + 1, 1 - lower).otherwise(upper)


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    first = F.lit(1.0) / _safe(1 - (a + b) * x / (a + 1))
    # the parameters travel in the state, so that the step's expression stays small
    state = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"), a.alias("a"), b.alias("b"), x.alias("x"))

    def step(s, j):
        m, a, b, x = F.ceil(j / 2), s["a"], s["b"], s["x"]
        # coefficients come in turns
        up = F.when(j % 2 == 1, m * (b - m) / ((a - 1 + 2 * m) * (a + 2 * m))) \
            .otherwise(-(a + m) * (a + b + m) / ((a + 2 * m) * (a + 1 + 2 * m))) * x
        c, d = _safe(1 + up / s["c"]), F.lit(1.0) / _safe(1 + up * s["d"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"), a.alias("a"), b.alias("b"), x.alias("x"))

    return _steps(4 * F.greatest(a, b), state, step, lambda s: s["h"])  # two steps a term


def beta_tail(a, b, odds) -> Column:
    """I_x(a, b), the regularised incomplete beta function at x = 1 / (1 + odds), odds >= 0.

    Given by the odds (1 - x) / x, as the tails of F and t distributions are: x may be
    too near 1 for 1 - x to be told from it."""
    a, b, odds = _lit(a), _lit(b), _lit(odds)
    x, y = 1 / (1 + odds), odds / (1 + odds)
    # 1 / B(a, b) by the larger of both, whose gamma functions nearly cancel
    high, low = F.greatest(a, b), F.least(a, b)
    log_lead = _log_gamma_step(high, low) - log_gamma(low) - a * F.log1p(odds) + b * F.log(F.greatest(y, F.lit(_TINY)))
    lead = F.exp(log_lead)
    near = x < (a + 1) / (a + b + 2)
    left = lead * _beta_fraction(a, b, x) / a
    right = 1 - lead * _beta_fraction(b, a, y) / b
    return F.when(odds <= 0, F.lit(1.0)).when(near, left).otherwise(right)


def chi_square_p(statistic, df) -> Column:
    """P(chi-square with ``df`` degrees > statistic)."""
    return gamma_q(_lit(df) / 2, _lit(statistic) / 2)


def f_p(statistic, df1, df2) -> Column:
    """P(F with (df1, df2) degrees > statistic)."""
    df1, df2 = _lit(df1), _lit(df2)
    return beta_tail(df2 / 2, df1 / 2, df1 * _lit(statistic) / df2)
