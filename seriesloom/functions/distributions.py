"""Tail probabilities for the few-row results of the statistical tests."""

from __future__ import annotations

import math

import numpy as np


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """lgamma per row, taken once for each value: degrees of freedom repeat."""
    values, places = np.unique(x, return_inverse=True)
    return np.array([math.lgamma(v) for v in values])[places.reshape(np.shape(x))]


def beta_inc_rows(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularized incomplete beta per row, by its continued fraction."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, x)))
    flip = x > (a + 1.0) / (a + b + 2.0)
    p, q, z = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1.0 - x, x)
    inside = (x > 0.0) & (x < 1.0)
    z = np.where(inside, z, 0.5)
    log_beta = _log_gamma(p) + _log_gamma(q) - _log_gamma(p + q)
    front = np.exp(p * np.log(z) + q * np.log1p(-z) - log_beta) / p
    # convergents from the recurrences for numerators and denominators, rescaled
    n0, n1 = np.zeros_like(z), np.ones_like(z)
    d0, d1 = np.ones_like(z), np.ones_like(z)
    value = n1 / d1
    for step in range(1, 400):
        m = step // 2
        if step % 2:
            term = -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))
        else:
            term = m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m))
        n0, n1 = n1, n1 + term * n0
        d0, d1 = d1, d1 + term * d0
        size = np.where(d1 == 0.0, 1.0, d1)
        n0, n1, d0, d1 = n0 / size, n1 / size, d0 / size, d1 / size
        if (np.abs(n1 - value) <= 1e-14 * np.abs(n1)).all():
            value = n1
            break
        value = n1
    tail = front * value
    return np.where(inside, np.where(flip, 1.0 - tail, tail), np.where(x <= 0.0, 0.0, 1.0))


def beta_inc(a: float, b: float, x: float) -> float:
    return float(beta_inc_rows(a, b, x))


def f_tail(f: float, df1: float, df2: float) -> float:
    """P(F > f)."""
    if f is None or math.isnan(f) or df1 <= 0 or df2 <= 0:
        return math.nan
    return beta_inc(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * f)) if f > 0 else 1.0


def t_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|)."""
    if t is None or math.isnan(t) or df <= 0:
        return math.nan
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


_erf = np.vectorize(math.erf, otypes=[float])


def _phi(z):
    return 0.5 * (1.0 + _erf(z / math.sqrt(2.0)))


def _normal_range_cdf(w, k: int, z, weight):
    """P(range of k standard normals < w) for an array of w."""
    inner = _phi(z)[None, :] - _phi(z[None, :] - np.atleast_1d(w)[:, None])
    density = np.exp(-z * z / 2.0) / math.sqrt(2.0 * math.pi)
    return k * (np.clip(inner, 0.0, 1.0) ** (k - 1) @ (density * weight))


def _log_gamma_rest(x: float) -> float:
    """lgamma(x) - x log x + x, by Stirling's series ten steps further up."""
    up = x + 10.0
    series = 1 / (12 * up) - 1 / (360 * up**3) + 1 / (1260 * up**5)
    steps = sum(math.log(x + i) for i in range(10))
    # (up - 1/2) log up - x log x - steps, with log up = log x + log1p(10 / x)
    return (x * math.log1p(10.0 / x) + 9.5 * math.log(up) - steps - 10.0
            + 0.5 * math.log(2.0 * math.pi) + series)


def studentized_range_tail(q: float, k: int, df: float) -> float:
    """P(Q > q) for k means and df error degrees of freedom, by quadrature."""
    if q is None or math.isnan(q) or k < 2 or df <= 0:
        return math.nan
    if q <= 0:
        return 1.0
    nodes, weights = np.polynomial.legendre.leggauss(96)
    z, wz = 8.0 * nodes, 8.0 * weights
    spread = 8.0 / math.sqrt(2.0 * df)
    low, high = max(1e-8, 1.0 - spread), 1.0 + spread + (4.0 if df < 4 else 0.0)
    s = low + (high - low) * (nodes + 1.0) / 2.0
    half, off = df / 2.0, s - 1.0
    # df/2 (1 - s^2 + 2 log s) near s = 1, without taking large terms from each other
    log_density = (math.log(2.0) - _log_gamma_rest(half) - np.log(s)
                   + half * (2.0 * (np.log1p(off) - off) - off * off))
    mass = np.exp(log_density) * weights * (high - low) / 2.0
    return float(min(1.0, max(0.0, 1.0 - mass @ _normal_range_cdf(q * s, k, z, wz))))


def studentized_range_critical(alpha: float, k: int, df: float) -> float:
    """The q with P(Q > q) = alpha."""
    low, high = 0.0, 100.0
    for _ in range(60):
        mid = (low + high) / 2.0
        if studentized_range_tail(mid, k, df) > alpha:
            low = mid
        else:
            high = mid
    return (low + high) / 2.0


def slope_p_values(r: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Two-sided p of regression slopes from their correlation and row count."""
    out = np.full(len(r), np.nan)
    known = (n > 2) & ~np.isnan(r)
    # t^2 = r^2 df / (1 - r^2), so df / (df + t^2) = 1 - r^2
    out[known] = beta_inc_rows((n[known] - 2.0) / 2.0, 0.5, 1.0 - np.minimum(1.0, r[known] ** 2))
    return out
