"""Tail probabilities as Arrow UDFs, applied to small result tables (tests, not cells)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_erfc = np.frompyfunc(math.erfc, 1, 1)
_lgamma = np.frompyfunc(math.lgamma, 1, 1)


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (Lentz's method)."""
    tiny = 1e-300

    def guard(v):
        return np.where(np.abs(v) < tiny, tiny, v)

    c = np.ones_like(x)
    d = 1.0 / guard(1.0 - (a + b) * x / (a + 1.0))
    h = d.copy()
    for m in range(1, 400):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1.0 / guard(1.0 + even * d)
        c = guard(1.0 + even / c)
        h = h * d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / guard(1.0 + odd * d)
        c = guard(1.0 + odd / c)
        h = h * d * c
        if np.all(np.abs(d * c - 1.0) < 1e-15):
            break
    return h


def beta_inc(a, b, x) -> np.ndarray:
    """Regularised incomplete beta function I_x(a, b)."""
    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    out = np.where(x <= 0, 0.0, 1.0)
    inner = (x > 0) & (x < 1)
    if not inner.any():
        return out
    ai, bi, xi = a[inner], b[inner], x[inner]
    log_front = (
        _lgamma(ai + bi).astype(float) - _lgamma(ai).astype(float) - _lgamma(bi).astype(float)
        + ai * np.log(xi) + bi * np.log1p(-xi)
    )
    front = np.exp(log_front)
    direct = xi < (ai + 1) / (ai + bi + 2)
    value = np.empty_like(xi)
    if direct.any():
        value[direct] = front[direct] * _beta_fraction(ai[direct], bi[direct], xi[direct]) / ai[direct]
    swap = ~direct
    if swap.any():
        value[swap] = 1 - front[swap] * _beta_fraction(bi[swap], ai[swap], 1 - xi[swap]) / bi[swap]
    out[inner] = value
    return out


def gamma_q(a, x) -> np.ndarray:
    """Regularised upper incomplete gamma function Q(a, x)."""
    a, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, x))
    out = np.ones_like(x)
    for i in np.ndindex(x.shape):
        if not x[i] > 0:
            continue
        s, v = float(a[i]), float(x[i])
        front = math.exp(s * math.log(v) - v - math.lgamma(s))
        if v < s + 1:
            term = total = 1.0 / s
            n = s
            while term > total * 1e-17:
                n += 1
                term *= v / n
                total += term
            out[i] = 1.0 - front * total
        else:
            b = v + 1 - s
            c, d = 1e300, 1 / b
            h = d
            for k in range(1, 1000):
                step = -k * (k - s)
                b += 2
                d = 1 / (step * d + b)
                c = b + step / c
                h *= d * c
                if abs(d * c - 1) < 1e-16:
                    break
            out[i] = front * h
    return out


def normal_two_sided(z: np.ndarray) -> np.ndarray:
    return _erfc(np.abs(np.asarray(z, dtype=float)) / math.sqrt(2)).astype(float)


def t_two_sided(t, df) -> np.ndarray:
    t, df = np.asarray(t, dtype=float), np.asarray(df, dtype=float)
    return beta_inc(df / 2, 0.5, df / (df + t * t))


@F.pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    """Two-sided p of a standard normal statistic."""
    ok = z.notna()
    out = pd.Series(np.nan, index=z.index)
    out[ok] = normal_two_sided(z[ok].to_numpy())
    return out.astype(object).where(ok, None)


@F.pandas_udf(DoubleType())
def student_p(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p of a Student t statistic."""
    ok = t.notna() & df.notna()
    out = pd.Series(np.nan, index=t.index)
    out[ok] = t_two_sided(t[ok].to_numpy(), df[ok].to_numpy())
    return out.astype(object).where(ok, None)


@F.pandas_udf(DoubleType())
def chi2_p(stat: pd.Series, df: pd.Series) -> pd.Series:
    """Upper-tail p of a chi-square statistic."""
    ok = stat.notna() & df.notna() & (df > 0)
    out = pd.Series(np.nan, index=stat.index)
    out[ok] = gamma_q(df[ok].to_numpy() / 2, stat[ok].to_numpy() / 2)
    return out.astype(object).where(ok, None)
