"""Distribution tails for p-values (no scipy in the image).

Regularised incomplete gamma and beta functions from the formulas of the Handbook of
Mathematical Functions (Abramowitz and Stegun, numbers below), exposed as
Arrow-batched pandas UDFs. They only ever run on result tables of a few
dozen rows (one row per tested feature), never on the data itself.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _fraction(numerator: Callable[[int], float], denominator: Callable[[int], float]) -> float:
    """``b0 + a1 / (b1 + a2 / (b2 + ...))``, worked out from its innermost term, ever deeper until two depths agree."""
    depth, shallower = 32, math.nan
    while True:
        value = denominator(depth)
        for k in range(depth, 0, -1):
            value = denominator(k - 1) + numerator(k) / value
        if abs(value - shallower) <= 1e-15 * abs(value) or depth >= 1 << 17:
            return value
        depth, shallower = 2 * depth, value


def gamma_q(a: float, x: float) -> float:
    """Upper regularised incomplete gamma Q(a, x): by its complement's series 6.5.29 left of the peak, by the fraction 6.5.31 right of it."""
    if x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    if x >= a + 1:
        fraction = _fraction(lambda k: k * (a - k), lambda k: x + 1 - a + 2 * k)
        return math.exp(a * math.log(x) - x - math.lgamma(a)) / fraction
    total, power, n = 0.0, 1.0, 0
    while power > 1e-17 * total:
        total += power
        n += 1
        power *= x / (a + n)
    return 1.0 - total * math.exp(a * math.log(x) - x - math.lgamma(a + 1))


def chi2_sf(x: float, k: float) -> float:
    """P(X > x) for chi-square with k degrees of freedom."""
    if x is None or k is None or k <= 0 or math.isnan(x):
        return float("nan")
    return gamma_q(k / 2.0, x / 2.0)


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b) by the fraction 26.5.8, from the side on which it converges fast (26.5.2)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x * (a + b + 2) >= a + 1:
        return 1.0 - beta_inc(b, a, 1.0 - x) if (1 - x) * (a + b + 2) < b + 1 else _beta_left(a, b, x)
    return _beta_left(a, b, x)


def _beta_left(a: float, b: float, x: float) -> float:
    def d(k: int) -> float:
        m, odd = divmod(k, 2)
        top = -(a + m) * (a + b + m) if odd else m * (b - m)
        return top * x / ((a + k - 1) * (a + k))

    front = math.lgamma(a + b) - math.lgamma(a + 1) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(front) / _fraction(d, lambda _: 1.0)


def t_sf2(t: float, dof: float) -> float:
    """Two-sided p-value of Student t."""
    if t is None or dof is None or dof <= 0 or math.isnan(t):
        return float("nan")
    if math.isinf(t):
        return 0.0
    return beta_inc(dof / 2.0, 0.5, dof / (dof + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    """P(F > f) for the F distribution."""
    if f is None or d1 is None or d2 is None or d1 <= 0 or d2 <= 0 or math.isnan(f):
        return float("nan")
    if f <= 0:
        return 1.0
    return beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def norm_sf2(z: float) -> float:
    """Two-sided normal p-value."""
    if z is None or math.isnan(z):
        return float("nan")
    return math.erfc(abs(z) / math.sqrt(2.0))


def _vec(fn, *cols: pd.Series) -> pd.Series:
    out = [fn(*[None if pd.isna(v) else float(v) for v in vals]) for vals in zip(*cols)]
    return pd.Series(out, dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_sf_udf(x: pd.Series, k: pd.Series) -> pd.Series:
    return _vec(chi2_sf, x, k)


@F.pandas_udf(T.DoubleType())
def t_sf2_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    return _vec(t_sf2, t, dof)


@F.pandas_udf(T.DoubleType())
def f_sf_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _vec(f_sf, f, d1, d2)


@F.pandas_udf(T.DoubleType())
def norm_sf2_udf(z: pd.Series) -> pd.Series:
    return _vec(norm_sf2, z)
