"""Shapiro-Wilk test of normality (Royston's 1995 approximation, algorithm AS R94), in numpy."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np

# Polynomials of the published approximation, highest power first.  The two largest weights
# are corrected by polynomials in 1 / sqrt(n); the statistic's transform is normal with mean and log deviation
# that are polynomials in n (4 to 11 values) or in log n (12 and more).
LARGEST_WEIGHT = [-2.706056, 4.434685, -2.071190, -0.147981, 0.221157]
SECOND_WEIGHT = [-3.582633, 5.682633, -1.752461, -0.293762, 0.042981]
SMALL_SHIFT = [0.459, -2.273]
SMALL_MEAN = [-0.0006714, 0.025054, -0.39978, 0.5440]
SMALL_LOG_SD = [-0.0020322, 0.062767, -0.77857, 1.3822]
LARGE_MEAN = [0.0038915, -0.083751, -0.31082, -1.5861]
LARGE_LOG_SD = [0.0030302, -0.082676, -0.4803]


def weights(n: int) -> np.ndarray:
    """The test's weights of ``n`` ordered values: antisymmetric, of length 1."""
    if n == 3:
        return np.array([-math.sqrt(0.5), 0.0, math.sqrt(0.5)])
    normal = NormalDist()
    m = np.array([normal.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    total = float(m @ m)
    u = 1 / math.sqrt(n)
    fixed = [np.polyval([*p, 0.0], u) + m[-k] / math.sqrt(total)
             for k, p in ((1, LARGEST_WEIGHT), (2, SECOND_WEIGHT))][:2 if n > 5 else 1]
    k = len(fixed)
    rest = (total - 2 * sum(m[-i - 1] ** 2 for i in range(k))) / (1 - 2 * sum(a * a for a in fixed))
    out = m / math.sqrt(rest)
    for i, a in enumerate(fixed):
        out[-i - 1], out[i] = a, -a
    return out


def shapiro_wilk(values) -> tuple[float, float]:
    """``(W, p)`` of 3 to 5000 values; NaN for fewer, or where all are equal."""
    x = np.sort(np.asarray(values, dtype=np.float64))
    n = len(x)
    if n > 5000:
        raise ValueError("the approximation holds up to 5000 values")
    if n < 3 or not x[-1] > x[0]:
        return math.nan, math.nan
    d = (x - x.mean()) / (x[-1] - x[0])
    w = min(1.0, float(weights(n) @ d) ** 2 / float(d @ d))
    if n == 3:
        return w, max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    if w == 1.0:
        return w, 1.0
    y = math.log1p(-w)
    if n < 12:
        shift = np.polyval(SMALL_SHIFT, n)
        if y >= shift:
            return w, 0.0
        y, mean, sd = -math.log(shift - y), np.polyval(SMALL_MEAN, n), math.exp(np.polyval(SMALL_LOG_SD, n))
    else:
        mean, sd = np.polyval(LARGE_MEAN, math.log(n)), math.exp(np.polyval(LARGE_LOG_SD, math.log(n)))
    return w, 0.5 * math.erfc((y - mean) / sd / math.sqrt(2))
