"""Student-t tail and quantile for the importance table.

These run on the driver over one row per feature.  The tail uses the
regularized incomplete beta function, evaluated by its continued fraction
(Lentz's method); the quantile inverts the tail by bisection.
"""

from __future__ import annotations

import math


def _betacf(a: float, b: float, x: float, iters: int = 300, eps: float = 1e-15) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < eps:
            break
    return h


def reg_incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    ln_front = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                + a * math.log(x) + b * math.log1p(-x))
    front = math.exp(ln_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def t_sf(t: float, df: float) -> float:
    """P(T > t) for Student's t with ``df`` degrees of freedom."""
    x = df / (df + t * t)
    tail = 0.5 * reg_incomplete_beta(df / 2.0, 0.5, x)
    return tail if t >= 0 else 1.0 - tail


def t_ppf(p: float, df: float) -> float:
    """Quantile: the t with P(T <= t) = p."""
    lo, hi = -1e6, 1e6
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if 1.0 - t_sf(mid, df) < p:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)


def importance_row(mean: float, std: float | None, n: int, confidence: float = 0.99
                   ) -> tuple[float | None, float | None, float | None]:
    """(p_value, ci_high, ci_low) of a one-sided t-test that the importance is > 0.

    Zero spread gives p = 0.5 and a zero-width interval, as in the reference table.
    """
    if n < 2 or std is None or math.isnan(std):
        return None, None, None
    if std == 0.0:
        return 0.5, mean, mean
    se = std / math.sqrt(n)
    p = t_sf(mean / se, n - 1)
    q = t_ppf(1.0 - (1.0 - confidence) / 2.0, n - 1)
    return p, mean + q * se, mean - q * se
