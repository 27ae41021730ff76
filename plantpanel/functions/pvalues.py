"""Tail probabilities of the usual test statistics, for small tables of results."""

from __future__ import annotations

import math

import numpy as np


def normal_two_sided(z: float) -> float:
    return math.erfc(max(z, 0.0) / math.sqrt(2.0)) if z == z else float("nan")


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 1000):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + top * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + top / c
            c = c if abs(c) > tiny else tiny
            h *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1.0
            term *= x / k
            total += term
        return 1.0 - front * total
    b, c = x + 1.0 - a, 1e300
    d = h = 1.0 / b
    for i in range(1, 10_000):
        top = -i * (i - a)
        b += 2.0
        d = 1.0 / (top * d + b or 1e-300)
        c = b + top / c or 1e-300
        h *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * h


def t_two_sided(t: float, df: float) -> float:
    if t != t or not df or df <= 0:
        return float("nan")
    return 0.0 if math.isinf(t) else incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def chi2_tail(x: float, df: float) -> float:
    return upper_gamma(df / 2.0, x / 2.0)


def f_tail(f: float, d1: float, d2: float) -> float:
    return 0.0 if math.isinf(f) else incomplete_beta(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def rank_sum_two_sided(u: float, n1: float, n0: float) -> float:
    """Exact two-sided p of Mann-Whitney's U without ties, from the number of orders that give each U.

    The counts are the coefficients of the Gaussian binomial: the product of
    (1 - q**(large + i)) / (1 - q**i) for i up to the smaller group's size.
    """
    small, large = sorted((int(n1), int(n0)))
    ways = np.zeros(small * large + 1, dtype=np.longdouble)
    ways[0] = 1
    for i in range(1, small + 1):
        ways[large + i :] = ways[large + i :] - ways[: max(0, len(ways) - large - i)]
        for start in range(i):
            ways[start::i] = np.cumsum(ways[start::i])
    far = int(math.ceil(max(u, n1 * n0 - u)))
    return float(min(1, 2 * ways[far:].sum() / ways.sum()))
