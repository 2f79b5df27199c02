"""Numeric helpers that follow R semantics.

Column expressions stay JVM-side; the two distribution functions Spark lacks (Student-t tail
probability and the binomial pmf) are Arrow-batched pandas UDFs over numpy.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def r_round(c: Column) -> Column:
    """R ``round(x)``: half to even (``rint``), never Spark's half-up ``round``."""
    return F.rint(c)


# ---------------------------------------------------------------- numpy kernels

def _fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction 1 / (1 + d1 / (1 + d2 / (1 + ...))) of the regularised incomplete beta function, with

        d_2m = m (b - m) x / ((a + 2m - 1) (a + 2m)),   d_2m+1 = -(a + m) (a + b + m) x / ((a + 2m) (a + 2m + 1)),

    evaluated from the last term back; the number of terms is doubled until the value stands still.
    """
    before = None
    for terms in (32, 64, 128, 256, 512, 1024, 2048):
        tail = np.zeros_like(x)
        for k in range(terms, 0, -1):
            m = k // 2
            top = m * (b - m) if k % 2 == 0 else -(a + m) * (a + b + m)
            tail = top * x / ((a + k - 1) * (a + k)) / (1.0 + tail)
        value = 1.0 / (1.0 + tail)
        if before is not None and np.all(np.abs(value - before) <= 4e-16 * np.abs(value)):
            break
        before = value
    return value


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Log gamma; the library function is called once per distinct value."""
    values, index = np.unique(x, return_inverse=True)
    return np.array([math.lgamma(v) for v in values])[index]


def betainc_reg(a, b, x) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b), vectorised."""
    a = np.asarray(a, dtype=float)
    b = np.asarray(b, dtype=float)
    x = np.asarray(x, dtype=float)
    a, b, x = np.broadcast_arrays(a, b, x)
    out = np.full(x.shape, np.nan)
    ok = (a > 0) & (b > 0) & (x >= 0) & (x <= 1)
    out[ok & (x == 0)] = 0.0
    out[ok & (x == 1)] = 1.0
    mid = ok & (x > 0) & (x < 1)
    if mid.any():
        am, bm, xm = a[mid], b[mid], x[mid]
        lbeta = _log_gamma(am + bm) - _log_gamma(am) - _log_gamma(bm)
        front = np.exp(lbeta + am * np.log(xm) + bm * np.log1p(-xm))
        direct = xm < (am + 1.0) / (am + bm + 2.0)
        res = np.empty_like(xm)
        if direct.any():
            res[direct] = front[direct] * _fraction(am[direct], bm[direct], xm[direct]) / am[direct]
        if (~direct).any():
            nd = ~direct
            res[nd] = 1.0 - front[nd] * _fraction(bm[nd], am[nd], 1.0 - xm[nd]) / bm[nd]
        out[mid] = res
    return out


def t_two_sided_np(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Two-sided tail probability of Student t: 2 * P(T > |t|) = I_{df/(df+t^2)}(df/2, 1/2)."""
    t = np.asarray(t, dtype=float)
    df = np.asarray(df, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        x = np.where(np.isinf(t), 0.0, df / (df + t * t))
    p = betainc_reg(df / 2.0, 0.5, x)
    return np.where(np.isnan(t) | ~(df > 0), np.nan, p)


def dbinom_np(k: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Binomial pmf with integer k, n (R ``dbinom``)."""
    k = np.asarray(k, dtype=float)
    n = np.asarray(n, dtype=float)
    p = np.asarray(p, dtype=float)
    k, n, p = np.broadcast_arrays(k, n, p)
    out = np.zeros(k.shape)
    out[np.isnan(k) | np.isnan(n) | np.isnan(p)] = np.nan
    fits = (k >= 0) & (k <= n)
    out[fits & (((p == 0) & (k == 0)) | ((p == 1) & (k == n)))] = 1.0
    mid = fits & (p > 0) & (p < 1)
    if mid.any():
        x, m, q = k[mid], n[mid], p[mid]
        choose = _log_gamma(m + 1) - _log_gamma(x + 1) - _log_gamma(m - x + 1)
        out[mid] = np.exp(choose + x * np.log(q) + (m - x) * np.log1p(-q))
    return out


# ---------------------------------------------------------------- pandas UDFs

@pandas_udf(DoubleType())
def _t_p_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_two_sided_np(t.to_numpy(dtype=float, na_value=np.nan),
                                    df.to_numpy(dtype=float, na_value=np.nan)))


@pandas_udf(DoubleType())
def _dbinom_udf(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
    return pd.Series(dbinom_np(k.to_numpy(dtype=float, na_value=np.nan),
                               n.to_numpy(dtype=float, na_value=np.nan),
                               p.to_numpy(dtype=float, na_value=np.nan)))


def t_statistic(n: Column, mean: Column, sd: Column, mu: Column) -> Column:
    """``(mean - mu) * sqrt(n) / sd`` (null when sd is 0)."""
    return F.try_divide((mean - mu) * F.sqrt(n.cast("double")), sd)


def t_pvalue_two_sided(n: Column, mean: Column, sd: Column, mu: Column, max_dist: float) -> Column:
    """Two-sided one-sample t-test p-value; a mean closer than ``max_dist`` to ``mu`` gives 1."""
    t = t_statistic(n, mean, sd, mu)
    p = _t_p_udf(t, (n - F.lit(1)).cast("double"))
    return F.when(F.abs(mean - mu) < F.lit(max_dist), F.lit(1.0)).otherwise(p)


def dbinom_clamped(sample_proportion: Column, sample_size: Column, pop_proportion: Column) -> Column:
    """Binomial probability of ``round(prop*size)`` successes, with count and p clamped to range."""
    k = F.least(F.greatest(r_round(sample_proportion * sample_size), F.lit(0.0)), sample_size.cast("double"))
    p = F.least(F.greatest(pop_proportion, F.lit(0.0)), F.lit(1.0))
    return _dbinom_udf(k, sample_size.cast("double"), p)


def t_critical_np(df: np.ndarray, alpha: float) -> np.ndarray:
    """Two-sided critical value: the t with 2 P(T > t) = alpha, by bisection on the same tail function."""
    df = np.asarray(df, dtype=float)
    lo = np.zeros_like(df)
    hi = np.full_like(df, 1e8)
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        p = t_two_sided_np(mid, df)
        big = p > alpha            # still above alpha -> critical value is further out
        lo = np.where(big, mid, lo)
        hi = np.where(big, hi, mid)
    return np.where(df > 0, 0.5 * (lo + hi), np.nan)


def t_critical_values(sizes, n: str, alpha: float, out: str = "t_crit"):
    """One row per distinct sample size with the two-sided critical t at level ``alpha`` (df = n - 1).

    ``p > alpha`` is the same test as ``|t| < t_crit``, since the tail probability falls in |t|; grid
    searches use this to test every cell with a comparison instead of a UDF call per cell.
    """
    from baflow.session import ship_package
    ship_package(sizes.sparkSession)

    @pandas_udf(DoubleType())
    def _crit(k: pd.Series) -> pd.Series:
        return pd.Series(t_critical_np(k.to_numpy(dtype=float) - 1.0, alpha))

    return sizes.select(n).distinct().withColumn(out, _crit(F.col(n).cast("double")))
