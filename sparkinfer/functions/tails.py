"""Tail probabilities for test results (t, F, chi-square, Kolmogorov, Shapiro-Wilk).

The pandas UDFs here run on *result rows* (one per test and group), never on the
fact table. Tails are evaluated in log space so that values near 1e-300 survive.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_TINY = 1e-300
#: Steps a series may take; what has not converged by then is NaN, never a value.
_STEPS = 200_000


def _each(function, x):
    """A scalar function over an array. (np.vectorize keeps state that cannot travel to executors.)"""
    x = np.asarray(x, dtype=float)
    return np.array([function(v) for v in x.ravel()], dtype=float).reshape(x.shape)


def _log_gamma(x):
    return _each(math.lgamma, x)


def _stirling_rest(x):
    """log Gamma(x) - ((x - 1/2) log x - x + log(2 pi) / 2), without the cancellation for large x."""
    x = np.asarray(x, dtype=float)
    big = np.maximum(x, 10.0)
    r = 1.0 / (big * big)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r * (1 / 1188 - r * 691 / 360360))))) / big
    small = np.minimum(np.maximum(x, _TINY), 10.0)
    direct = _log_gamma(small) - ((small - 0.5) * np.log(small) - small + 0.5 * math.log(2 * math.pi))
    return np.where(x >= 10.0, series, direct)


def _log_beta_front(p, q, u, v):
    """log(u^p v^q / (p B(p, q))) with u + v = 1, where p + q may be 1e12 and more."""
    s, g = np.minimum(p, q), np.maximum(p, q)
    ratio = (-(g - 0.5) * np.log1p(s / g) - s * np.log(s + g) + s
             + _stirling_rest(g) - _stirling_rest(s + g))
    log_u = np.where(v < 0.5, np.log1p(-np.minimum(v, 0.5)), np.log(u))
    log_v = np.where(u < 0.5, np.log1p(-np.minimum(u, 0.5)), np.log(v))
    return p * log_u + q * log_v - np.log(p) - _log_gamma(s) - ratio


def _guard(z):
    return np.where(np.abs(z) < _TINY, _TINY, z)


def _beta_fraction(a, b, x):
    """Continued fraction of the incomplete beta function (Lentz's method)."""
    c = np.ones_like(x)
    d = 1.0 / _guard(1.0 - (a + b) * x / (a + 1.0))
    h = d.copy()
    for m in range(1, _STEPS):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1.0 / _guard(1.0 + even * d)
        c = _guard(1.0 + even / c)
        h *= d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / _guard(1.0 + odd * d)
        c = _guard(1.0 + odd / c)
        delta = d * c
        h *= delta
        if np.all(np.abs(delta - 1.0) < 1e-15):
            return h
    return np.where(np.abs(delta - 1.0) < 1e-12, h, np.nan)


def beta_lower(a, b, x, y):
    """Regularised incomplete beta I_x(a, b); ``y`` is 1 - x, passed in to keep digits."""
    a, b, x, y = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x, y))
    out = np.full(x.shape, np.nan)
    ok = (a > 0) & (b > 0) & (x >= 0) & (y >= 0)
    edge0, edge1 = ok & (x <= 0), ok & (y <= 0)
    out[edge0], out[edge1] = 0.0, 1.0
    inside = ok & ~edge0 & ~edge1
    swap = inside & (x > (a + 1.0) / (a + b + 2.0))
    for side, flip in ((inside & ~swap, False), (swap, True)):
        if not side.any():
            continue
        p, q, u, v = ((b, a, y, x) if flip else (a, b, x, y))
        p, q, u, v = p[side], q[side], u[side], v[side]
        value = np.exp(_log_beta_front(p, q, u, v)) * _beta_fraction(p, q, u)
        out[side] = 1.0 - value if flip else value
    return out


def _log_gamma_front(s, z):
    """log(z^s e^-z / Gamma(s)), near z = s for very large s too."""
    off = (z - s) / s
    return s * (np.log1p(off) - off) + 0.5 * np.log(s / (2 * math.pi)) - _stirling_rest(s)


def gamma_upper(a, x):
    """Regularised upper incomplete gamma Q(a, x)."""
    a, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, x))
    out = np.full(x.shape, np.nan)
    ok = (a > 0) & (x >= 0)
    out[ok & (x == 0)] = 1.0
    low = ok & (x > 0) & (x < a + 1.0)
    high = ok & (x >= a + 1.0)
    if low.any():
        s, z = a[low], x[low]
        term = 1.0 / s
        total = term.copy()
        k = s.copy()
        for _ in range(_STEPS):
            k += 1.0
            term = term * z / k
            total += term
            if np.all(term < total * 1e-16):
                break
        total = np.where(term < total * 1e-13, total, np.nan)
        out[low] = 1.0 - np.exp(_log_gamma_front(s, z)) * total
    if high.any():
        s, z = a[high], x[high]
        b = z + 1.0 - s
        c = np.full_like(z, 1.0 / _TINY)
        d = 1.0 / _guard(b)
        h = d.copy()
        for i in range(1, _STEPS):
            an = -i * (i - s)
            b = b + 2.0
            d = 1.0 / _guard(an * d + b)
            c = _guard(b + an / c)
            delta = d * c
            h *= delta
            if np.all(np.abs(delta - 1.0) < 1e-15):
                break
        h = np.where(np.abs(delta - 1.0) < 1e-12, h, np.nan)
        out[high] = np.exp(_log_gamma_front(s, z)) * h
    return out


#: From so many degrees of freedom on, and at most 1e-5 of them above the line, Bartlett's form is exact to 1e-11.
_LARGE_DF = 1e7


def _f_upper_large(f, d1, d2):
    """P(F > f) for d2 far above d1: -(d2 + d1/2 - 1) log(Lambda) is chi-square to order (d1/d2)^2."""
    return gamma_upper(d1 / 2.0, 0.5 * (d2 + d1 / 2.0 - 1.0) * np.log1p(d1 * f / d2))


def t_upper(t, df):
    """P(T > t)."""
    t, df = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(t, df))
    half = 0.5 * f_upper(t * t, 1.0, df)
    return np.where(np.isnan(half), np.nan, np.where(t >= 0, half, 1.0 - half))


def f_upper(f, d1, d2):
    """P(F > f)."""
    f, d1, d2 = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(f, d1, d2))
    large = (d2 >= _LARGE_DF) & (d1 <= d2 * 1e-5) & np.isfinite(f)
    with np.errstate(invalid="ignore", divide="ignore"):
        scale = d2 + d1 * f
        out = beta_lower(d2 / 2.0, d1 / 2.0, d2 / scale, d1 * f / scale)
        if large.any():
            out[large] = _f_upper_large(f[large], d1[large], d2[large])
    return np.where(np.isinf(f), 0.0, out)


def t_quantile(p, df):
    """Inverse of the t distribution function, by bisection on the upper tail."""
    p, df = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(p, df))
    tail = np.minimum(p, 1.0 - p)
    low, high = np.zeros_like(tail), np.ones_like(tail)
    for _ in range(1100):
        short = t_upper(high, df) > tail
        if not short.any():
            break
        high = np.where(short, high * 2.0, high)
    for _ in range(200):
        mid = 0.5 * (low + high)
        above = t_upper(mid, df) > tail
        low, high = np.where(above, mid, low), np.where(above, high, mid)
        if np.all(high - low <= 1e-15 * np.maximum(high, 1e-12)):
            break
    size = 0.5 * (low + high)
    size = np.where(np.isnan(p) | np.isnan(df) | (df <= 0), np.nan, size)
    return np.where(p >= 0.5, size, -size)


def _one_sided_smirnov(d, n):
    """Exact P(D+ >= d) by the Birnbaum-Tingey sum, in log space."""
    j = np.arange(0, int(math.floor(n * (1.0 - d))) + 1, dtype=float)
    rest = 1.0 - d - j / n
    j, rest = j[rest > 0], rest[rest > 0]
    log_comb = math.lgamma(n + 1) - _log_gamma(j + 1) - _log_gamma(n - j + 1)
    logs = log_comb + (j - 1) * np.log(d + j / n) + (n - j) * np.log(rest)
    top = logs.max()
    return min(1.0, math.exp(top + math.log(np.exp(logs - top).sum()) + math.log(d)))


def _two_sided_kolmogorov(d, n):
    """Exact P(D < d) as a matrix power (Durbin; Marsaglia, Tsang and Wang 2003)."""
    k = int(n * d) + 1
    size, h = 2 * k - 1, k - n * d
    i, j = np.indices((size, size))
    step = i - j + 1
    base = np.where(step >= 0, 1.0, 0.0)
    powers = h ** np.arange(1, size + 1)
    base[:, 0] -= powers
    base[-1, :] -= powers[::-1]
    base[-1, 0] += max(0.0, 2 * h - 1) ** size
    base *= np.exp(-_log_gamma(np.maximum(step, 0) + 1.0))
    # square and multiply, with the scale kept apart as a logarithm
    result, log_result, log_base, left = np.eye(size), 0.0, 0.0, int(n)
    while left:
        if left & 1:
            result, log_result = result @ base, log_result + log_base
            top = np.abs(result).max()
            result, log_result = result / top, log_result + math.log(top)
        left >>= 1
        if left:
            base, log_base = base @ base, 2 * log_base
            top = np.abs(base).max()
            base, log_base = base / top, log_base + math.log(top)
    centre = result[k - 1, k - 1]
    if centre <= 0:
        return 0.0
    return math.exp(math.log(centre) + log_result + math.lgamma(n + 1) - n * math.log(n))


def _one_sided_by_integral(d, n):
    """P(D+ >= d) for large n: the Birnbaum-Tingey sum over j as an integral over t = j / n.

    The summand is smooth and vanishes at both ends, so Gauss-Legendre points give the sum to
    working precision, at any n.
    """
    x, w = np.polynomial.legendre.leggauss(400)
    t = 0.5 * (1.0 - d) * (x + 1.0)
    w = 0.5 * (1.0 - d) * w
    log_f = (n * (t * np.log1p(d / t) + (1.0 - t) * np.log1p(-d / (1.0 - t))) - np.log(t + d)
             - 0.5 * np.log(2 * math.pi * n * t * (1.0 - t))
             + _stirling_rest(np.array(float(n))) - _stirling_rest(n * t) - _stirling_rest(n * (1.0 - t)))
    top = log_f.max()
    return math.exp(top + math.log((np.exp(log_f - top) * w).sum()) + math.log(d) + math.log(n))


def _pelz_good(d, n):
    """P(D < d) by the expansion of Pelz and Good (1976), to order n^(-3/2)."""
    z = math.sqrt(n) * d
    if z < 0.04:
        return 0.0
    pi2, z2 = math.pi ** 2, z * z
    half = (np.arange(0, 40) + 0.5) ** 2
    e_half = 2.0 * np.exp(-pi2 * half / (2 * z2))
    whole = np.arange(1, 40, dtype=float) ** 2
    e_whole = 2.0 * np.exp(-pi2 * whole / (2 * z2))
    root = math.sqrt(math.pi / 2)
    k0 = 2 * root / z * e_half.sum() / 2
    k1 = root / (6 * z2 ** 2) * ((pi2 * half - z2) * e_half).sum()
    k2 = (root / (72 * z ** 7) * ((6 * z2 ** 3 + 2 * z2 ** 2 + pi2 * (2 * z2 ** 2 - 5 * z2) * half
                                   + pi2 ** 2 * (1 - 2 * z2) * half ** 2) * e_half).sum()
          - root / (36 * z ** 3) * (pi2 * whole * e_whole).sum())
    k3 = (root / (6480 * z ** 10) * ((-30 * z2 ** 3 - 90 * z2 ** 4 + pi2 * (135 * z2 ** 2 - 96 * z2 ** 3) * half
                                      + pi2 ** 2 * (212 * z2 ** 2 - 60 * z2) * half ** 2
                                      + pi2 ** 3 * (5 - 30 * z2) * half ** 3) * e_half).sum()
          + root / (216 * z ** 6) * ((3 * pi2 * whole * z2 - pi2 ** 2 * whole ** 2) * e_whole).sum())
    return k0 + k1 / math.sqrt(n) + k2 / n + k3 / n ** 1.5


def kolmogorov_upper(d, n):
    """Two-sided one-sample Kolmogorov-Smirnov p-value.

    Exact up to n = 10,000: a matrix power near the centre, twice the one-sided tail far out
    (n d^2 >= 2.2). Beyond, the same two parts from expansions that hold at any n: Pelz and
    Good near the centre, and far out the one-sided tail by quadrature, less the first term that
    counts both sides.
    """
    if not (n > 0) or math.isnan(d):
        return math.nan
    if d <= 0:
        return 1.0
    if d >= 1:
        return 0.0
    far = n * d * d
    if n <= 10_000:
        if far >= 2.2:
            return min(1.0, 2.0 * _one_sided_smirnov(d, n))
        return min(1.0, max(0.0, 1.0 - _two_sided_kolmogorov(d, n)))
    if far >= 2.2:
        return min(1.0, 2.0 * _one_sided_by_integral(d, n) - 2.0 * math.exp(-8.0 * far))
    return min(1.0, max(0.0, 1.0 - _pelz_good(d, n)))


def _kolmogorov_each(d, n):
    return np.array([kolmogorov_upper(a, b) for a, b in zip(d, n, strict=True)], dtype=float)


def _pandas_udf(fn, arity):
    if arity == 1:
        raise ValueError("use a column expression")

    def two(a: pd.Series, b: pd.Series) -> pd.Series:
        values = fn(a.to_numpy(dtype=float), b.to_numpy(dtype=float))
        return pd.Series(values).where(~np.isnan(values), None).astype("Float64")

    def three(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        values = fn(a.to_numpy(dtype=float), b.to_numpy(dtype=float), c.to_numpy(dtype=float))
        return pd.Series(values).where(~np.isnan(values), None).astype("Float64")

    return F.pandas_udf(two if arity == 2 else three, DoubleType())


_t_upper = _pandas_udf(t_upper, 2)
_t_quantile = _pandas_udf(t_quantile, 2)
_f_upper = _pandas_udf(f_upper, 3)
_chi2_upper = _pandas_udf(lambda x, df: gamma_upper(df / 2.0, x / 2.0), 2)
_ks_upper = _pandas_udf(_kolmogorov_each, 2)


def _double(*columns):
    return [c.cast("double") for c in columns]


def t_sf(t: Column, df: Column) -> Column:
    return _t_upper(*_double(t, df))


def t_ppf(p: Column, df: Column) -> Column:
    return _t_quantile(*_double(p, df))


def f_sf(f: Column, d1: Column, d2: Column) -> Column:
    return _f_upper(*_double(f, d1, d2))


def chi2_sf(x: Column, df: Column) -> Column:
    return _chi2_upper(*_double(x, df))


def ks_sf(d: Column, n: Column) -> Column:
    return _ks_upper(*_double(d, n))


ALTERNATIVES = ("two-sided", "greater", "less")


def _check(alternative: str) -> None:
    if alternative not in ALTERNATIVES:
        raise ValueError(f"alternative must be one of {ALTERNATIVES}, not {alternative!r}")


def t_p_value(t: Column, df: Column, alternative: str = "two-sided") -> Column:
    _check(alternative)
    if alternative == "two-sided":
        return F.when(t.isNotNull(), F.least(F.lit(1.0), F.lit(2.0) * t_sf(F.abs(t), df)))
    return t_sf(t if alternative == "greater" else -t, df)


# Polynomial coefficients of P. Royston, algorithm AS R94,
# Applied Statistics 44 (1995), highest power first.
SW_LAST = (-2.706056, 4.434685, -2.071190, -0.147981, 0.221157)
SW_NEXT = (-3.582633, 5.682633, -1.752461, -0.293762, 0.042981)
SW_SMALL_GAMMA = (0.459, -2.273)
SW_SMALL_MU = (-0.0006714, 0.025054, -0.39978, 0.5440)
SW_SMALL_SIGMA = (-0.0020322, 0.062767, -0.77857, 1.3822)
SW_LARGE_MU = (0.0038915, -0.083751, -0.31082, -1.5861)
SW_LARGE_SIGMA = (0.0030302, -0.082676, -0.4803)


def shapiro_upper(w, n):
    """P-value of the Shapiro-Wilk W statistic (Royston's normalising transform)."""
    w, n = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(w, n))
    with np.errstate(all="ignore"):
        log_n = np.log(n)
        deficit = np.log(np.maximum(1.0 - w, 1e-300))
        gamma = np.polyval(SW_SMALL_GAMMA, n)
        small = ((-np.log(gamma - deficit) - np.polyval(SW_SMALL_MU, n))
                 / np.exp(np.polyval(SW_SMALL_SIGMA, n)))
        large = (deficit - np.polyval(SW_LARGE_MU, log_n)) / np.exp(np.polyval(SW_LARGE_SIGMA, log_n))
        z = np.where(n <= 11, small, large)
        p = 0.5 * _each(math.erfc, z / math.sqrt(2.0))
        p = np.where((n <= 11) & (gamma <= deficit), 1e-99, p)
        three = 6.0 / math.pi * (np.arcsin(np.sqrt(np.minimum(w, 1.0))) - math.asin(math.sqrt(0.75)))
        p = np.where(n == 3, np.maximum(three, 0.0), p)
    return np.where(np.isnan(w) | ~(n >= 3), np.nan, p)


_shapiro_upper = _pandas_udf(shapiro_upper, 2)


def shapiro_sf(w: Column, n: Column) -> Column:
    return _shapiro_upper(*_double(w, n))

