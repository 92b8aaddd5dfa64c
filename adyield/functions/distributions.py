"""Student-t and beta distribution functions, evaluated on Arrow batches."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# ship these helpers inside the task, so that workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Lanczos approximation of log gamma (g = 7, nine terms).
_LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)

#: From here on, for both parameters, the density is integrated; below, the continued fraction settles within so many steps.
LARGE = 300.0
HUGE = 1e5
STEPS = 20_000
_LEGENDRE = np.polynomial.legendre.leggauss(64)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    z = x - 1.0
    series = np.full_like(z, _LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:], start=1):
        series = series + c / (z + i)
    t = z + 7.5
    return 0.5 * np.log(2 * np.pi) + (z + 0.5) * np.log(t) - t + np.log(series)


def _tail(z: np.ndarray) -> np.ndarray:
    """What log gamma has beyond ``(z - 1/2) log z - z + log(2 pi) / 2``, for z of 15 and more."""
    r = 1 / (z * z)
    return (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r / 1188)))) / z


def _log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the beta function; log gammas of large arguments are never subtracted from one another."""
    small, large = np.minimum(a, b), np.maximum(a, b)
    plain = _log_gamma(small) + _log_gamma(large) - _log_gamma(small + large)
    far = np.maximum(large, 15.0)
    # log gamma(large) - log gamma(large + small)
    drop = -(far - 0.5) * np.log1p(small / far) - small * np.log(far + small) + small + _tail(far) - _tail(far + small)
    return np.where(large < 15, plain, _log_gamma(small) + drop)


def _fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz steps)."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, STEPS):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + numerator / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            step = c * d
            h = h * step
        if np.all(np.abs(step - 1.0) < 1e-15):
            return h
    raise ArithmeticError(f"the incomplete beta function did not settle within {STEPS} steps")


def _series(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Power series of the incomplete beta function; all terms are positive."""
    total, term = np.ones_like(x), np.ones_like(x)
    for n in range(STEPS):
        term = term * (a + b + n) * x / (a + 1 + n)
        total = total + term
        if np.all(term < 1e-17 * total):
            return total
    raise ArithmeticError(f"the incomplete beta function did not settle within {STEPS} steps")


def _by_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    inside, rest = np.maximum(x, 1e-300), np.maximum(y, 1e-300)
    logs = np.where(inside > 0.5, np.log1p(-np.minimum(rest, 0.5)), np.log(inside)), np.where(rest > 0.5, np.log1p(-np.minimum(inside, 0.5)), np.log(rest))
    front = np.exp(a * logs[0] + b * logs[1] - _log_beta(a, b))
    flip = inside > (a + 1) / (a + b + 2)
    # beside a huge parameter, a variable close to 1 has no digits left: the small side's power series has no need of it
    own, at = np.where(a < b, a, b), np.where(a < b, inside, rest)
    thin = (np.maximum(a, b) >= HUGE) & ((a + b) * at <= own + 6 * np.sqrt(own) + 10)
    value = np.empty_like(a)
    if thin.any():
        low = front[thin] * _series(own[thin], np.maximum(a, b)[thin], at[thin]) / own[thin]
        value[thin] = np.where(a[thin] < b[thin], low, 1 - low)
    if (~thin).any():
        p, q, at = np.where(flip, b, a)[~thin], np.where(flip, a, b)[~thin], np.where(flip, rest, inside)[~thin]
        part = front[~thin] * _fraction(p, q, at) / p
        value[~thin] = np.where(flip[~thin], 1 - part, part)
    return value


def _log1p_rest(u: np.ndarray) -> np.ndarray:
    """log(1 + u) - u without cancellation."""
    near = np.where(np.abs(u) < 0.1, u, 0.0)
    series = np.zeros_like(near)
    for k in range(18, 1, -1):
        series = series * near + (1.0 if k % 2 else -1.0) / k
    return np.where(np.abs(u) < 0.1, series * near * near, np.log1p(np.maximum(u, -1 + 1e-16)) - u)


def _by_quadrature(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Both parameters large: the density around its mean, where first-order terms cancel on paper, integrated over the nearer tail."""
    mean, rest = a / (a + b), b / (a + b)
    off = x * rest - y * mean
    flip = off > 0
    a, b, mean, rest, at, off = (np.where(flip, v, u) for u, v in ((a, b), (b, a), (mean, rest), (rest, mean), (x, y), (off, -off)))
    spread = np.sqrt(mean * rest / (a + b))
    away = -off / spread
    reach = np.minimum(at, spread * (np.sqrt(away * away + 90.0) - away))
    total = np.zeros_like(at)
    for node, weight in zip(*_LEGENDRE):
        back = reach * (node + 1) / 2
        d = off - back
        height = a * _log1p_rest(d / mean) + b * _log1p_rest(-d / rest)
        total = total + weight * np.exp(height) / np.maximum((at - back) * (1 - at + back), 1e-300)
    scale = np.sqrt(a * b / (2 * np.pi * (a + b))) * np.exp(_tail(a + b) - _tail(a) - _tail(b))
    value = np.clip(total * reach / 2 * scale, 0.0, 1.0)
    return np.where(flip, 1 - value, value)


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray, rest: np.ndarray | None = None) -> np.ndarray:
    """Regularised incomplete beta function; NaN outside a > 0, b > 0. ``rest`` is 1 - x where that is known better than x is.

    A continued fraction, or where both parameters are large a quadrature; it raises rather than give a value that has not settled.
    """
    a, b, x, y = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x, 1.0 - np.asarray(x, float) if rest is None else rest))
    valid = (a > 0) & (b > 0) & ~np.isnan(x)
    a1, b1 = np.where(valid, a, 1.0), np.where(valid, b, 1.0)
    x1, y1 = np.clip(np.where(valid, x, 0.5), 0.0, 1.0), np.clip(np.where(valid, y, 0.5), 0.0, 1.0)
    large = np.minimum(a1, b1) >= LARGE
    value = np.empty_like(a1)
    for chosen, function in ((large, _by_quadrature), (~large, _by_fraction)):
        if chosen.any():
            value[chosen] = function(a1[chosen], b1[chosen], x1[chosen], y1[chosen])
    value = np.where(x1 <= 0, 0.0, np.where(y1 <= 0, 1.0, value))
    return np.where(valid, value, np.nan)


def t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    t, df = np.asarray(t, dtype=float), np.asarray(df, dtype=float)
    return incomplete_beta(df / 2.0, np.full_like(df, 0.5), df / (df + t * t), t * t / (df + t * t))


def beta_quantile(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    p, a, b = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(p, a, b))
    low, high = np.zeros_like(a), np.ones_like(a)
    for _ in range(100):
        mid = (low + high) / 2
        below = incomplete_beta(a, b, mid) < p
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return np.where((a > 0) & (b > 0), (low + high) / 2, np.nan)


def t_quantile(p: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Upper quantile for p >= .5, by halving the interval on the share of the two tails."""
    p, df = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(p, df))
    low, high = np.zeros_like(df), np.ones_like(df)
    # rest = t * t / (df + t * t) is what is searched, so that many degrees of freedom do not crowd at one end
    for step in range(1100):
        mid = np.where(low == 0, high / 2, np.sqrt(low * high)) if step < 40 else (low + high) / 2
        inside = incomplete_beta(df / 2.0, np.full_like(df, 0.5), 1 - mid, mid) > 2 * (1 - p)
        low, high = np.where(inside, mid, low), np.where(inside, high, mid)
        if np.all((high - low <= 4e-16 * high) | (high < 1e-300) | np.isnan(df)):
            break
    rest = (low + high) / 2
    return np.where(df > 0, np.sqrt(df * rest / (1 - rest)), np.nan)


def _null_safe(values: np.ndarray) -> pd.Series:
    return pd.Series(values).astype(object).where(~np.isnan(values), None).astype("Float64")


@F.pandas_udf(DoubleType())
def t_two_sided_p(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p value of a t statistic."""
    return _null_safe(t_two_sided(t.to_numpy(dtype=float), df.to_numpy(dtype=float)))


@F.pandas_udf(DoubleType())
def t_upper_quantile(p: pd.Series, df: pd.Series) -> pd.Series:
    return _null_safe(t_quantile(p.to_numpy(dtype=float), df.to_numpy(dtype=float)))


@F.pandas_udf(DoubleType())
def beta_ppf(p: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
    """Quantile of the beta distribution; NULL where a parameter is not positive."""
    return _null_safe(beta_quantile(*(s.to_numpy(dtype=float) for s in (p, a, b))))
