"""Distribution tails for p-values and critical values (Student t, F, chi-square).

scipy is not available, so the regularised incomplete beta and gamma functions
are evaluated here with numpy, a whole Arrow batch at a time. The leading
factors are written so that large parameters cancel analytically (Stirling
remainders and log1p differences), and an expansion that has not converged
yields NaN (NULL in the result), never an unfinished value.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TINY, _CLOSE = 1e-290, 4e-16
_HALF_LOG_2PI = 0.5 * np.log(2 * np.pi)
#: From this shape on the gamma tail uses its uniform expansion (error below 1e-9).
_LARGE_SHAPE = 1e6


def _stirling_rest(x: np.ndarray) -> np.ndarray:
    """log gamma(x) - ((x - 1/2) log x - x + log sqrt(2 pi)), x >= 10."""
    r = 1.0 / (x * x)
    return (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r / 1188)))) / x


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log gamma for x > 0: shifted up to 10 or more, then Stirling's series."""
    x = np.asarray(x, dtype=float)
    shift, y = np.zeros_like(x), x.copy()
    for _ in range(10):
        low = y < 10
        shift[low] += np.log(y[low])
        y[low] += 1
    return (y - 0.5) * np.log(y) - y + _HALF_LOG_2PI + _stirling_rest(y) - shift


def _log1p_minus(d: np.ndarray) -> np.ndarray:
    """log(1 + d) - d without cancellation near 0."""
    small = np.abs(d) < 0.05
    s = np.where(small, d, 0.0)
    series = np.zeros_like(s)
    for k in range(16, 1, -1):
        series = s * series + (-1.0 if k % 2 == 0 else 1.0) / k
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(small, s * s * series, np.log1p(np.where(small, 1.0, d)) - np.where(small, 1.0, d))


def _log_beta_density(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """log of x**a y**b / B(a, b), with y = 1 - x given exactly."""
    out = np.empty_like(a)
    big, small = np.maximum(a, b), np.minimum(a, b)
    plain = big < 10
    with np.errstate(divide="ignore"):
        lx = np.where(y < 0.5, np.log1p(-np.minimum(y, 0.5)), np.log(x))
        ly = np.where(x < 0.5, np.log1p(-np.minimum(x, 0.5)), np.log(y))
    p = plain
    out[p] = a[p] * lx[p] + b[p] * ly[p] + _log_gamma(a[p] + b[p]) - _log_gamma(a[p]) - _log_gamma(b[p])
    one = ~plain & (small < 10)  # only the larger parameter is expanded
    s, g = small[one], big[one]
    grow = (g - 0.5) * np.log1p(s / g) + s * np.log(g + s) - s + _stirling_rest(g + s) - _stirling_rest(g)
    out[one] = a[one] * lx[one] + b[one] * ly[one] + grow - _log_gamma(s)
    both = ~plain & ~one
    aa, bb, lean = a[both], b[both], (x * b - y * a)[both]
    n = aa + bb
    out[both] = (aa * _log1p_minus(lean / aa) + bb * _log1p_minus(-lean / bb) + 0.5 * np.log(aa * (bb / n)) - _HALF_LOG_2PI
                 + _stirling_rest(n) - _stirling_rest(aa) - _stirling_rest(bb))
    return out


def _fraction(first: np.ndarray, term, rounds: int) -> np.ndarray:
    """first + n1/(d1 + n2/(d2 + ...)), forward evaluation by ratios of successive
    convergents; term(k) gives (n_k, d_k). NaN where ``rounds`` are not enough."""
    value = np.where(first == 0, _TINY, first).astype(float)
    upper, lower = value.copy(), np.zeros_like(value)
    done = np.zeros(value.shape, dtype=bool)
    for k in range(1, rounds + 1):
        n, d = term(k)
        lower = d + n * lower
        lower = 1.0 / np.where(np.abs(lower) < _TINY, _TINY, lower)
        upper = d + n / upper
        upper = np.where(np.abs(upper) < _TINY, _TINY, upper)
        factor = np.where(done, 1.0, upper * lower)
        value = value * factor
        done |= np.abs(factor - 1.0) < _CLOSE
        if done.all():
            return value
    return np.where(done, value, np.nan)


def _rounds(largest: np.ndarray) -> int:
    """Convergence takes a multiple of the square root of the largest parameter."""
    return int(500 + 20 * np.sqrt(largest.max(initial=0.0)))


def beta_tail(a, b, x, y) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b); ``y`` is 1 - x, given so that neither loses digits."""
    a, b, x, y = (np.atleast_1d(np.asarray(v, dtype=float)) for v in np.broadcast_arrays(a, b, x, y))
    out = np.where(x <= 0, 0.0, np.where(y <= 0, 1.0, np.nan))
    inner = np.flatnonzero((x > 0) & (y > 0) & (a > 0) & (b > 0))
    if not len(inner):
        return out
    a, b, x, y = a[inner], b[inner], x[inner], y[inner]
    small, big = np.minimum(a, b), np.maximum(a, b)
    limit = (big >= 1e7) & (small**3 < 1e-12 * big**2)
    if limit.any():  # gamma limit of one large parameter, error of the order small**3 / big**2
        near_one = np.where(a > b, y, x)  # the argument that stays small
        with np.errstate(divide="ignore"):
            w = (big + (small - 1) / 2) * -np.where(near_one < 0.5, np.log1p(-np.minimum(near_one, 0.5)), np.log(np.where(a > b, x, y)))
        q = gamma_tail(small[limit], w[limit])
        out[inner[limit]] = np.where(a[limit] > b[limit], q, 1.0 - q)
        inner, a, b, x, y = inner[~limit], a[~limit], b[~limit], x[~limit], y[~limit]
        if not len(inner):
            return out
    mirror = x * (a + b + 2) > a + 1
    a, b, x, y = (np.where(mirror, q, p) for p, q in ((a, b), (b, a), (x, y), (y, x)))

    def term(k):
        if k == 1:
            return np.ones_like(a), np.ones_like(a)
        m, odd = divmod(k - 1, 2)
        if odd:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    part = np.exp(_log_beta_density(a, b, x, y)) / a * _fraction(np.zeros_like(a), term, _rounds(np.maximum(a, b)))
    out[inner] = np.clip(np.where(mirror, 1.0 - part, part), 0.0, 1.0)
    return out


def _erfc(z: np.ndarray) -> np.ndarray:
    """Complementary error function through the gamma tail of shape 1/2."""
    tail = gamma_tail(np.full_like(z, 0.5), z * z)
    return np.where(z >= 0, tail, 2.0 - tail)


def gamma_tail(s, x) -> np.ndarray:
    """Regularised upper incomplete gamma Q(s, x)."""
    s, x = (np.atleast_1d(np.asarray(v, dtype=float)) for v in np.broadcast_arrays(s, x))
    out = np.where(x <= 0, 1.0, np.nan)
    ok = (x > 0) & (s > 0)
    large = np.flatnonzero(ok & (s >= _LARGE_SHAPE))
    if len(large):
        # uniform expansion: half an error function plus its first correction
        shape, lean = s[large], (x[large] - s[large]) / s[large]
        exponent = -_log1p_minus(lean)  # eta**2 / 2
        eta = np.sign(lean) * np.sqrt(2 * exponent)
        near = np.abs(lean) < 1e-4
        with np.errstate(divide="ignore", invalid="ignore"):
            c = np.where(near, -1 / 3 + lean / 12, 1 / lean - 1 / eta)
        out[large] = np.clip(0.5 * _erfc(eta * np.sqrt(shape / 2)) + np.exp(-shape * exponent) / np.sqrt(2 * np.pi * shape) * c, 0, 1)
    rest = np.flatnonzero(ok & (s < _LARGE_SHAPE))
    if len(rest):
        s, x = s[rest], x[rest]
        front = np.where(s >= 10, s * _log1p_minus((x - s) / s) + 0.5 * np.log(s) - _HALF_LOG_2PI - _stirling_rest(np.maximum(s, 10)),
                         -x + s * np.log(x) - _log_gamma(s))
        front = np.exp(front)
        res = np.empty_like(s)
        low = x < s + 1
        if low.any():  # the power series of the lower part
            sl, xl = s[low], x[low]
            term = 1.0 / sl
            total, done = term.copy(), np.zeros(sl.shape, dtype=bool)
            for k in range(1, _rounds(sl) + 1):
                term = term * xl / (sl + k)
                total = np.where(done, total, total + term)
                done |= term < total * _CLOSE
                if done.all():
                    break
            res[low] = 1.0 - np.where(done, total, np.nan) * front[low]
        if (~low).any():
            sh, xh = s[~low], x[~low]

            def step(k):
                return (np.ones_like(sh), xh + 1 - sh) if k == 1 else ((k - 1) * (sh - (k - 1)), xh + 2 * k - 1 - sh)

            res[~low] = front[~low] * _fraction(np.zeros_like(sh), step, _rounds(sh))
        out[rest] = np.clip(res, 0.0, 1.0)
    return out


def t_sf_two_sided(t, df) -> np.ndarray:
    """P(|T| >= |t|) for Student t with df degrees of freedom."""
    t, df = (np.atleast_1d(np.asarray(v, dtype=float)) for v in np.broadcast_arrays(t, df))
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        r = t / np.sqrt(df)  # ratios keep t * t from overflowing
        wide = np.abs(r) > 1
        inv = 1 / np.where(r == 0, np.inf, r)
        x = np.where(wide, inv * inv / (1 + inv * inv), 1 / (1 + r * r))
        y = np.where(wide, 1 / (1 + inv * inv), r * r / (1 + r * r))
        p = beta_tail(df / 2, 0.5, x, y)
    return np.where(np.isnan(t) | ~(df > 0), np.nan, np.where(np.isinf(t), 0.0, p))


def t_ppf(q, df) -> np.ndarray:
    """Inverse of the t distribution function, by halving a bracket that holds the root."""
    q, df = (np.atleast_1d(np.asarray(v, dtype=float)) for v in np.broadcast_arrays(q, df))
    out = np.full(q.shape, np.nan)
    out[(q == 0) & (df > 0)], out[(q == 1) & (df > 0)], out[(q == 0.5) & (df > 0)] = -np.inf, np.inf, 0.0
    use = np.flatnonzero((df > 0) & (q > 0) & (q < 1) & (q != 0.5))
    if len(use):
        p, d = 2 * np.minimum(q[use], 1 - q[use]), df[use]
        low, high = np.zeros(len(use)), np.ones(len(use))
        while (beyond := t_sf_two_sided(high, d) > p).any():
            low, high = np.where(beyond, high, low), np.where(beyond, high * 2, high)
        while True:
            mid = low + (high - low) / 2
            if not ((mid > low) & (mid < high)).any():
                break
            above = t_sf_two_sided(mid, d) > p
            low, high = np.where(above, mid, low), np.where(above, high, mid)
        root = np.where(np.isnan(t_sf_two_sided(high, d)), np.nan, high)
        out[use] = np.where(q[use] > 0.5, root, -root)
    return out


def f_sf(f, d1, d2) -> np.ndarray:
    """P(F >= f) for the F distribution."""
    f, d1, d2 = (np.atleast_1d(np.asarray(v, dtype=float)) for v in np.broadcast_arrays(f, d1, d2))
    with np.errstate(invalid="ignore"):
        r = d1 / d2 * f
        p = beta_tail(d2 / 2, d1 / 2, 1 / (1 + r), np.where(np.isinf(r), 1.0, r / (1 + r)))
        return np.where(np.isnan(f) | ~(d1 > 0) | ~(d2 > 0), np.nan, np.where(f <= 0, 1.0, p))


def chi2_sf(x, k) -> np.ndarray:
    x, k = (np.atleast_1d(np.asarray(v, dtype=float)) for v in np.broadcast_arrays(x, k))
    return np.where(np.isnan(x) | ~(k > 0), np.nan, np.where(x == np.inf, 0.0, gamma_tail(k / 2, np.where(np.isnan(x), 0, x) / 2)))


def _vectorise(fn):
    @F.pandas_udf(T.DoubleType())
    def udf(*cols: pd.Series) -> pd.Series:
        arrays = [c.to_numpy(dtype="float64", na_value=np.nan) for c in cols]
        known = ~np.isnan(arrays).any(axis=0)
        out = np.full(len(known), np.nan)
        if known.any():
            out[known] = fn(*(a[known] for a in arrays))
        return pd.Series(out)
    return udf


t_two_sided_p = _vectorise(t_sf_two_sided)
t_quantile = _vectorise(t_ppf)
f_upper_p = _vectorise(f_sf)
chi2_upper_p = _vectorise(chi2_sf)


def nan_to_null(c):
    return F.when(~F.isnan(c), c)
