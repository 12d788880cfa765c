"""Tail probabilities for one result row per model (no SciPy in the image)."""

from __future__ import annotations

import math


def normal_two_sided(z: float) -> float:
    """P(|Z| > |z|)."""
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi2_upper(x: float, df: int) -> float:
    """P(X > x) for a whole number of degrees of freedom, as a finite sum."""
    if x <= 0.0:
        return 1.0
    half = x / 2.0
    if df % 2:
        out, order = math.erfc(math.sqrt(half)), 0.5
    else:
        out, order = math.exp(-half), 1.0
    while order < df / 2.0:
        out += math.exp(order * math.log(half) - half - math.lgamma(order + 1.0))
        order += 1.0
    return out


def beta_lower(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_lower(b, a, 1.0 - x)
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    tiny = 1e-300
    numer, denom = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    denom = 1.0 / (denom or tiny)
    fraction = denom
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            denom = 1.0 / ((1.0 + step * denom) or tiny)
            numer = (1.0 + step / numer) or tiny
            change = denom * numer
            fraction *= change
        if abs(change - 1.0) < 1e-15:
            break
    return math.exp(log_front) * fraction / a


def f_upper(f: float, df1: float, df2: float) -> float:
    """P(F > f)."""
    if f <= 0.0:
        return 1.0
    return beta_lower(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * f))
