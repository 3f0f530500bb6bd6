"""Tail probabilities for result rows.

Spark SQL has no incomplete beta or gamma function. The tables they apply to hold
one row per feature or category, so an Arrow function over the batch is enough.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

TINY = 1e-300
STEPS = 500


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz method)."""
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > TINY else TINY)
    value = d
    for m in range(1, STEPS):
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > TINY else TINY)
            c = 1.0 + term / c
            c = c if abs(c) > TINY else TINY
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0.0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        for _ in range(STEPS * 20):
            n += 1.0
            term *= x / n
            total += term
            if term < total * 1e-16:
                break
        return max(0.0, 1.0 - front * total)
    b = x + 1.0 - a
    c, d = 1.0 / TINY, 1.0 / b
    value = d
    for i in range(1, STEPS * 20):
        step = -i * (i - a)
        b += 2.0
        d = 1.0 / (step * d + b or TINY)
        c = b + step / c or TINY
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * value


def norm_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def t_two_sided(t: float, df: float) -> float:
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


def f_tail(f: float, d1: float, d2: float) -> float:
    return beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f)) if f > 0 else 1.0


def chi2_tail(x: float, df: float) -> float:
    return gamma_upper(df / 2.0, x / 2.0)


def _rowwise(fn, *series: pd.Series) -> pd.Series:
    out = []
    for args in zip(*series):
        known = all(v is not None and not math.isnan(v) for v in args)
        out.append(fn(*map(float, args)) if known else None)
    return pd.Series(out, dtype="float64")


@F.pandas_udf(DoubleType())
def p_norm(z: pd.Series) -> pd.Series:
    return _rowwise(norm_two_sided, z)


@F.pandas_udf(DoubleType())
def p_t(t: pd.Series, df: pd.Series) -> pd.Series:
    return _rowwise(t_two_sided, t, df)


@F.pandas_udf(DoubleType())
def p_f(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _rowwise(f_tail, f, d1, d2)


@F.pandas_udf(DoubleType())
def p_chi2(x: pd.Series, df: pd.Series) -> pd.Series:
    return _rowwise(chi2_tail, x, df)
