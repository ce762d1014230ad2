"""Distribution functions that SQL lacks: regularised incomplete gamma (vectorised) and the F quantile (scalar)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def gamma_cdf(a: float, x: np.ndarray) -> np.ndarray:
    """Regularised lower incomplete gamma P(a, x): a power series below a + 1, a continued fraction above; NaN for negative x."""
    x = np.asarray(x, float)
    out = np.full(x.shape, np.nan)
    out[x == 0] = 0.0
    out[np.isposinf(x)] = 1.0
    with np.errstate(all="ignore"):
        low = np.flatnonzero((x > 0) & (x < a + 1))
        if len(low):
            v = x[low]
            term = np.full(len(v), 1 / a)
            total, k = term.copy(), a
            for _ in range(10_000):
                k += 1
                term = term * v / k
                total += term
                if (term < total * 1e-17).all():
                    break
            out[low] = total * np.exp(a * np.log(v) - v - math.lgamma(a))
        high = np.flatnonzero((x >= a + 1) & np.isfinite(x))
        if len(high):
            v, tiny = x[high], 1e-300
            b = v + 1 - a
            c, d = np.full(len(v), 1 / tiny), 1 / b
            h = d.copy()
            for i in range(1, 10_000):
                an = -i * (i - a)
                b = b + 2
                d = an * d + b
                d = 1 / np.where(np.abs(d) < tiny, tiny, d)
                c = b + an / c
                c = np.where(np.abs(c) < tiny, tiny, c)
                step = c * d
                h *= step
                if (np.abs(step - 1) < 1e-16).all():
                    break
            out[high] = 1 - h * np.exp(a * np.log(v) - v - math.lgamma(a))
    return out


def chi2_cdf(value: Column, df: float) -> Column:
    """Distribution function of chi-squared; NULL for NULL, NaN and negative values."""

    @F.pandas_udf(T.DoubleType())
    def run(x: pd.Series) -> pd.Series:
        p = gamma_cdf(df / 2, x.to_numpy(float) / 2)
        return pd.Series(p).astype(object).where(~np.isnan(p), None).astype(float)

    out = run(value)
    return F.when(~F.isnan(out), out)


def beta_cdf(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_cdf(b, a, 1 - x)
    tiny = 1e-300
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10_000):
        for numerator in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + numerator * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + numerator / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * h


def f_cdf(x: float, d1: float, d2: float) -> float:
    return beta_cdf(d1 / 2, d2 / 2, d1 * x / (d1 * x + d2)) if x > 0 else 0.0


def f_quantile(q: float, d1: float, d2: float) -> float:
    """The value below which a share q of the F distribution lies, by bisection; NaN for arguments out of range."""
    if not (0 <= q <= 1 and d1 > 0 and d2 > 0):
        return math.nan
    if q in (0.0, 1.0):
        return math.inf if q else 0.0
    lo, hi = 0.0, 1.0
    while f_cdf(hi, d1, d2) < q:
        lo, hi = hi, hi * 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f_cdf(mid, d1, d2) < q else (lo, mid)
    return (lo + hi) / 2


def f_quantiles(q: float, d1: Column, d2: Column) -> Column:
    """f_quantile() of columns of degrees of freedom; NULL where they are out of range.  For a value a scene, not a pixel."""

    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([f_quantile(q, x, y) for x, y in zip(a.fillna(-1), b.fillna(-1), strict=True)], dtype=float)

    out = run(d1, d2)
    return F.when(~F.isnan(out), out)
