"""p-values of the two drift tests, from the few numbers Spark's aggregates leave."""

from __future__ import annotations

import math

import numpy as np

KS_METHODS = ("asymptotic", "exact")
# Largest sample the exact count is done for.
EXACT_KS_ROWS = 10_000
# Largest matrix that is raised to a power; beyond it the law's expansion is exact to eight digits and more.
_MATRIX = 201
_MATRIX_ROWS = 5_000


def ks_p_value(statistic: float, n_ref: int, n_cur: int, method: str = "asymptotic") -> float:
    """Two-sided two-sample Kolmogorov-Smirnov p-value; an empty sample gives 1.

    `asymptotic` takes Kolmogorov's law for one sample of the size m n / (m + n), rounded, but no less than the chance that
    two samples lie wholly apart, which is the least that any gap can have; `exact` counts orderings. The sizes never choose
    between the two: `exact` raises on samples it is too slow for.
    """
    if method not in KS_METHODS:
        raise ValueError(f"unknown method: {method}")
    if n_ref == 0 or n_cur == 0:
        return 1.0
    if method == "asymptotic":
        orderings = math.lgamma(n_ref + n_cur + 1) - math.lgamma(n_ref + 1) - math.lgamma(n_cur + 1)
        apart = min(1.0, 2.0 * math.exp(-orderings))
        return max(apart, ks_tail(statistic, max(1, round(n_ref * (n_cur / (n_ref + n_cur))))))
    if max(n_ref, n_cur) > EXACT_KS_ROWS:
        raise ValueError(f"the exact p-value takes samples of at most {EXACT_KS_ROWS} rows")
    return _ks_exact(statistic, n_ref, n_cur)


def ks_tail(distance: float, n: int) -> float:
    """Chance that the largest gap between n uniform numbers' empirical law and the law itself is at least `distance`."""
    x = distance * math.sqrt(n)
    if 2 * n * distance <= 1:
        return 1.0
    if distance >= 1:
        return 0.0
    if x * x > 18:
        return min(1.0, 2.0 * math.exp(-2.0 * x * x))  # the one-sided tails, which no longer overlap
    size = 2 * math.ceil(n * distance) - 1
    below = _ks_matrix(distance, n) if size <= _MATRIX and n <= _MATRIX_ROWS else _ks_expansion(x, n)
    return min(1.0, max(0.0, 1.0 - below))


def _ks_matrix(distance: float, n: int) -> float:
    """P(gap < distance), from the n-th power of a matrix of chances between lattice corridors, with powers of ten aside."""
    k = math.ceil(n * distance)
    size, h = 2 * k - 1, k - n * distance
    step = np.arange(size)[:, None] - np.arange(size)[None, :] + 1
    base = np.where(step >= 0, 1.0, 0.0)
    edge = h ** np.arange(1, size + 1)
    base[:, 0] -= edge
    base[-1, :] -= edge[::-1]
    base[-1, 0] += max(2 * h - 1, 0.0) ** size
    factorials = np.array([math.lgamma(i + 1) for i in range(size + 1)])
    base *= np.where(step > 0, np.exp(-factorials[np.maximum(step, 0)]), 1.0)

    power, tens, base_tens, left = np.eye(size), 0, 0, n
    while left:
        if left & 1:
            power, tens = power @ base, tens + base_tens
        base, base_tens = base @ base, 2 * base_tens
        for _ in range(2):
            if power[k - 1, k - 1] > 1e140:
                power, tens = power * 1e-140, tens + 140
            if base[k - 1, k - 1] > 1e140:
                base, base_tens = base * 1e-140, base_tens + 140
        left >>= 1
    log = math.log(power[k - 1, k - 1]) + tens * math.log(10) + math.lgamma(n + 1) - n * math.log(n)
    return math.exp(log)


def _ks_expansion(x: float, n: int) -> float:
    """P(sqrt(n) gap < x) by powers of 1 / sqrt(n) up to the third, each a theta-like series."""
    odd = (np.arange(-40, 40) + 0.5) * math.pi
    even = np.arange(-40, 41) * math.pi
    at_odd, at_even = np.exp(-(odd**2) / (2 * x * x)), np.exp(-(even**2) / (2 * x * x))
    scale = math.sqrt(math.pi / 2)
    zeroth = scale / x * at_odd.sum()
    first = scale / (6 * x**4) * ((odd**2 - x**2) * at_odd).sum()
    second = scale / (72 * x**7) * (
        (6 * x**6 + 2 * x**4 + (2 * x**4 - 5 * x**2) * odd**2 + (1 - 2 * x**2) * odd**4) * at_odd
    ).sum() - scale / (36 * x**3) * (even**2 * at_even).sum()
    third = scale / (6480 * x**10) * (
        ((5 - 30 * x**2) * odd**6 + (212 * x**4 - 60 * x**2) * odd**4 + (135 * x**4 - 96 * x**6) * odd**2 - 30 * x**6 - 90 * x**8) * at_odd
    ).sum() + scale / (216 * x**6) * ((3 * x**2 * even**2 - even**4) * at_even).sum()
    return float(zeroth + first / n**0.5 + second / n + third / n**1.5)


def _ks_exact(statistic: float, m: int, n: int) -> float:
    """Share of all orderings of the two samples whose distance reaches the statistic.

    An ordering is a lattice path to (m, n); it reaches the distance where |i n - j m| >= D m n. For paths through
    (i, j), `reached` is the share that has done so by then; all orderings being equally likely, it is the mean of the
    two predecessors weighted i : j. One step per diagonal i + j.
    """
    limit = round(statistic * m * n)
    if limit <= 0:
        return 1.0
    i = np.arange(m + 1, dtype=np.int64)
    reached = np.zeros(m + 1)
    for diagonal in range(1, m + n + 1):
        j = diagonal - i
        from_i = np.concatenate(([0.0], reached[:-1])) * i
        reached = (from_i + reached * j) / diagonal
        inside = (j >= 0) & (j <= n)
        reached[inside & (np.abs(i * n - j * m) >= limit)] = 1.0
        reached[~inside] = 0.0
    return float(min(1.0, max(0.0, reached[m])))


def chi2_p_value(statistic: float, degrees: int) -> float:
    """Upper tail of the chi-square distribution; no degrees of freedom give 1."""
    if degrees <= 0 or statistic <= 0:
        return 1.0
    return _upper_gamma(degrees / 2.0, statistic / 2.0)


def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function: a series below a + 1, a continued fraction above."""
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        step = a
        while abs(term) > abs(total) * 1e-16:
            step += 1.0
            term *= x / step
            total += term
        return max(0.0, 1.0 - total * scale)
    # Lentz's method
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    fraction = d
    for i in range(1, 100_000):
        numerator = -i * (i - a)
        b += 2.0
        d = 1.0 / ((numerator * d + b) or tiny)
        c = (b + numerator / c) or tiny
        fraction *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return min(1.0, scale * fraction)
    raise ArithmeticError("the continued fraction did not converge")
