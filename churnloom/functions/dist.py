"""Distribution functions for single test statistics. Only ever applied to aggregates on the driver."""

from __future__ import annotations

import math
from statistics import NormalDist

_EPS = 1e-14


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def normal_ppf(p: float) -> float:
    return NormalDist().inv_cdf(p)


def gamma_p(a: float, x: float) -> float:
    """Regularised lower incomplete gamma: a power series left of a+1, a continued fraction right of it."""
    if x <= 0:
        return 0.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * _EPS:
            k += 1
            term *= x / k
            total += term
        return min(1.0, total * scale)
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 10_000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or 1e-300)
        c = b + step / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < _EPS:
            break
    return max(0.0, 1.0 - scale * h)


def beta_cdf(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta by its continued fraction."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_cdf(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    f = c = 1.0
    d = 0.0
    for i in range(10_000):
        m = i // 2
        if i == 0:
            step = 1.0
        elif i % 2 == 0:
            step = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            step = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + step * d or 1e-300)
        c = 1 + step / c or 1e-300
        f *= c * d
        if i and abs(1 - c * d) < _EPS:
            break
    return min(1.0, front * (f - 1))


def beta_ppf(p: float, a: float, b: float) -> float:
    low, high = 0.0, 1.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if beta_cdf(mid, a, b) < p else (low, mid)
    return (low + high) / 2


def chi2_sf(x: float, dof: float) -> float:
    return 1.0 - gamma_p(dof / 2, x / 2) if dof > 0 else float("nan")


def f_sf(x: float, d1: float, d2: float) -> float:
    if x <= 0:
        return 1.0
    return beta_cdf(d2 / (d2 + d1 * x), d2 / 2, d1 / 2)


def t_two_sided(t: float, dof: float) -> float:
    return beta_cdf(dof / (dof + t * t), dof / 2, 0.5)


def t_ppf_two_sided(alpha: float, dof: float) -> float:
    """Critical |t| with two-sided tail ``alpha``."""
    low, high = 0.0, 1e3
    for _ in range(90):
        mid = (low + high) / 2
        low, high = (mid, high) if t_two_sided(mid, dof) > alpha else (low, mid)
    return (low + high) / 2


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def pearson_p(r: float, n: int) -> float:
    if n < 3:
        return float("nan")
    if abs(r) >= 1:
        return 0.0
    return t_two_sided(r * math.sqrt((n - 2) / (1 - r * r)), n - 2)


def lilliefors_p(d: float, n: int) -> float:
    """Dallal and Wilkinson's approximation (1986), cut at 0.1 where it stops being accurate."""
    if n > 100:
        d, n = d * (n / 100) ** 0.49, 100
    p = math.exp(
        -7.01256 * d * d * (n + 2.78019)
        + 2.99587 * d * math.sqrt(n + 2.78019)
        - 0.122119
        + 0.974598 / math.sqrt(n)
        + 1.67997 / n
    )
    return min(p, 1.0)


def anderson_normal_p(a2: float, n: int) -> float:
    """D'Agostino and Stephens (1986) for an unknown mean and variance."""
    a = a2 * (1 + 0.75 / n + 2.25 / n**2)
    if a >= 0.6:
        p = math.exp(1.2937 - 5.709 * a + 0.0186 * a * a) if a < 153 else 0.0
    elif a > 0.34:
        p = math.exp(0.9177 - 4.279 * a - 1.38 * a * a)
    elif a > 0.2:
        p = 1 - math.exp(-8.318 + 42.796 * a - 59.938 * a * a)
    else:
        p = 1 - math.exp(-13.436 + 101.14 * a - 223.73 * a * a)
    return max(0.0, min(1.0, p))


def shapiro_francia_p(w: float, n: int) -> float:
    """Royston's normalising transform (1993) for 5 <= n <= 5000."""
    u = math.log(math.log(n)) - math.log(n)
    v = math.log(math.log(n)) + 2 / math.log(n)
    mean, sd = -1.2725 + 1.0521 * u, 1.0308 - 0.26758 * v
    return 1 - normal_cdf((math.log(max(1 - w, 1e-300)) - mean) / sd)
