"""Tail probabilities of the usual distributions, from math alone, and their pandas UDFs."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for k in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + k * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + k / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def t_two_sided(t: float, df: float) -> float:
    return beta_inc(df / 2, 0.5, df / (df + t * t))


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while term > total * 1e-16:
            k += 1
            term *= x / k
            total += term
        return 1 - front * total
    b = x + 1 - a
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = 1 / ((an * d + b) or 1e-300)
        c = (b + an / c) or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def chi2_upper(x: float, df: float) -> float:
    return gamma_upper(df / 2, x / 2)


def ks_upper(d: float, n: int, m: int) -> float:
    """Two-sample Kolmogorov-Smirnov, asymptotic."""
    if d <= 0:
        return 1.0
    en = math.sqrt(n * m / (n + m))
    lam = (en + 0.12 + 0.11 / en) * d
    s = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    return min(1.0, max(0.0, s)) if lam > 0.2 else 1.0


def _each(f):
    def run(*cols: pd.Series) -> pd.Series:
        return pd.Series([None if any(pd.isna(v) for v in row) else f(*row) for row in zip(*cols, strict=True)], dtype="float64")

    return run


@F.pandas_udf(T.DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return _each(normal_two_sided)(z)


@F.pandas_udf(T.DoubleType())
def t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return _each(t_two_sided)(t, df)


@F.pandas_udf(T.DoubleType())
def chi2_p(x: pd.Series, df: pd.Series) -> pd.Series:
    return _each(chi2_upper)(x, df)


@F.pandas_udf(T.DoubleType())
def ks_p(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return _each(ks_upper)(d, n, m)
