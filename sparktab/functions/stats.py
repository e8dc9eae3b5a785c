"""Distribution functions evaluated inside Arrow batches (vectorised numpy, no SciPy)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _betacf(a, b, x, iters: int = 200, eps: float = 1e-15):
    """Continued fraction of the regularised incomplete beta (modified Lentz), vectorised."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < tiny, tiny, d)
    d = 1.0 / d
    h = d.copy()
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        delta = d * c
        h *= delta
        if np.all(np.abs(delta - 1.0) < eps):
            break
    return h


def betainc(a, b, x):
    """Regularised incomplete beta I_x(a, b) for arrays (a, b > 0, 0 <= x <= 1)."""
    from math import lgamma
    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    out = np.full(x.shape, np.nan)
    lg = np.vectorize(lgamma)
    ok = (x >= 0) & (x <= 1) & (a > 0) & (b > 0)
    if not ok.any():
        return out
    a_, b_, x_ = a[ok], b[ok], x[ok]
    with np.errstate(divide="ignore", invalid="ignore"):
        lbt = lg(a_ + b_) - lg(a_) - lg(b_) + a_ * np.log(np.where(x_ > 0, x_, 1)) \
            + b_ * np.log(np.where(x_ < 1, 1 - x_, 1))
        bt = np.where((x_ == 0) | (x_ == 1), 0.0, np.exp(lbt))
        swap = x_ >= (a_ + 1) / (a_ + b_ + 2)
        res = np.empty_like(x_)
        ns = ~swap
        res[ns] = bt[ns] * _betacf(a_[ns], b_[ns], x_[ns]) / a_[ns]
        res[swap] = 1.0 - bt[swap] * _betacf(b_[swap], a_[swap], 1 - x_[swap]) / b_[swap]
    res = np.where(x_ == 0, 0.0, np.where(x_ == 1, 1.0, res))
    out[ok] = res
    return out


def t_two_sided_p(t, df):
    """Two-sided p-value of Student's t: I_{df/(df+t^2)}(df/2, 1/2)."""
    t = np.asarray(t, dtype=float)
    df = np.asarray(df, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        x = df / (df + t * t)
    p = betainc(df / 2.0, np.full_like(df, 0.5), x)
    return np.where(np.isinf(t), 0.0, p)


@F.pandas_udf(T.DoubleType())
def t_pvalue_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    """Arrow-batched p-value column; applied to result rows (model pairs), never to data rows."""
    return pd.Series(t_two_sided_p(t.to_numpy(dtype=float, na_value=np.nan), df.to_numpy(dtype=float, na_value=np.nan)))
