"""Upper-tail probabilities of the test statistics, as pandas UDFs over small result tables.

Series and continued fractions for the incomplete gamma and beta functions follow the NIST Digital Library of
Mathematical Functions (8.7, 8.9, 8.17.22); the studentized range is integrated by Gauss-Legendre quadrature.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_TINY, _EPS, _STEPS = 1e-300, 1e-15, 10_000


def _lentz(term, first: float) -> float:
    """Continued fraction first + a1/(b1 + a2/(b2 + ...)) by the modified Lentz method."""
    f = first or _TINY
    c, d = f, 0.0
    for i in range(1, _STEPS):
        a, b = term(i)
        d = 1.0 / ((b + a * d) or _TINY)
        c = (b + a / c) or _TINY
        f *= c * d
        if abs(c * d - 1.0) < _EPS:
            break
    return f


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_inc(b, a, 1.0 - x)

    def term(i: int) -> tuple[float, float]:
        if i == 1:
            return 1.0, 1.0
        m, odd = divmod(i - 1, 2)
        if odd:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(front) / a * _lentz(term, 0.0)


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        total = term = 1.0 / a
        k = a
        while term > total * _EPS:
            k += 1.0
            term *= x / k
            total += term
        return max(0.0, 1.0 - front * total)
    return front * _lentz(lambda i: (1.0 if i == 1 else -(i - 1) * (i - 1 - a), x + 2 * i - 1 - a), 0.0)


def f_tail(stat: float, df1: float, df2: float) -> float:
    return beta_inc(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * stat)) if stat > 0 else 1.0


def t_two_sided(stat: float, df: float) -> float:
    return beta_inc(df / 2.0, 0.5, df / (df + stat * stat))


def chi2_tail(stat: float, df: float) -> float:
    return gamma_upper(df / 2.0, stat / 2.0)


_X, _W = np.polynomial.legendre.leggauss(96)


def _on(low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    return (high - low) / 2 * _X + (high + low) / 2, (high - low) / 2 * _W


_Z, _ZW = _on(-8.5, 8.5)
_PHI = np.exp(-_Z * _Z / 2) / math.sqrt(2 * math.pi)
_CDF = np.vectorize(lambda v: 0.5 * math.erfc(-v / math.sqrt(2)))


def _range_cdf(widths: np.ndarray, k: int) -> np.ndarray:
    """P(range of k standard normals <= w) for each width."""
    upper = _CDF(_Z)[None, :]
    lower = _CDF(_Z[None, :] - widths[:, None])
    return k * ((_ZW * _PHI)[None, :] * (upper - lower) ** (k - 1)).sum(axis=1)


def studentized_range_tail(q: float, k: int, df: float) -> float:
    """P(Q > q) for k means and df error degrees of freedom."""
    if q <= 0:
        return 1.0
    half = 9.0 / math.sqrt(2.0 * df)
    s, w = _on(max(1e-8, 1.0 - half), 1.0 + half) if df > 4 else _on(1e-8, 8.0)
    t = s - 1.0  # the exponent around its top at 1, so that no large numbers cancel
    log_density = math.log(2.0) - _gamma_front(df / 2) + df * (np.log1p(t) - t - t * t / 2) - np.log(s)
    return float(np.clip(1.0 - (w * np.exp(log_density) * _range_cdf(q * s, k)).sum(), 0.0, 1.0))


def _gamma_front(a: float) -> float:
    """lgamma(a) - a log(a) + a, for large a by Stirling's series."""
    if a < 50.0:
        return math.lgamma(a) - a * math.log(a) + a
    return 0.5 * math.log(2 * math.pi / a) + 1 / (12 * a) - 1 / (360 * a**3) + 1 / (1260 * a**5)


def studentized_range_quantile(p: float, k: int, df: float) -> float:
    """q with P(Q <= q) = p, by bisection."""
    low, high = 0.0, 1.0
    while studentized_range_tail(high, k, df) > 1.0 - p:
        high *= 2.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if studentized_range_tail(mid, k, df) > 1.0 - p else (low, mid)
    return (low + high) / 2


def _wrapped(fn, *args: Column) -> Column:
    def apply(*series: pd.Series) -> pd.Series:
        rows = zip(*[s.astype(float) for s in series])
        return pd.Series([None if any(v != v for v in r) else fn(*r) for r in rows], dtype="float64")

    # pandas_udf reads the arity from type hints, so one fixed-arity function per width.
    if len(args) == 2:

        def call2(a: pd.Series, b: pd.Series) -> pd.Series:
            return apply(a, b)

        return F.pandas_udf(call2, "double")(*args)

    def call3(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return apply(a, b, c)

    return F.pandas_udf(call3, "double")(*args)


def f_p_value(stat: Column, df1: Column, df2: Column) -> Column:
    return _wrapped(f_tail, stat, df1, df2)


def t_p_value(stat: Column, df: Column) -> Column:
    return _wrapped(t_two_sided, stat, df)


def chi2_p_value(stat: Column, df: Column) -> Column:
    return _wrapped(chi2_tail, stat, df)


def tukey_p_value(q: Column, k: Column, df: Column) -> Column:
    return _wrapped(lambda q_, k_, df_: studentized_range_tail(q_, int(k_), df_), q, k, df)


def tukey_critical(p: Column, k: Column, df: Column) -> Column:
    return _wrapped(lambda p_, k_, df_: studentized_range_quantile(p_, int(k_), df_), p, k, df)
