"""Tail probabilities for result tables, as Arrow-batched functions.

Incomplete beta and gamma functions by continued fractions and series over whole batches, where finished rows leave
the iteration; exact rank distributions by counting, once per pair of sample sizes.  They run on rows of statistics,
never on raw data.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TINY = 1e-300
#: Steps after which an iteration that still moves is taken as it is.
STEPS = 100_000


def log_gamma(x) -> np.ndarray:
    """log Gamma of positive numbers: Stirling's series after a shift to 10 or more."""
    x = np.array(x, dtype=float)
    shift = np.zeros_like(x)
    while (low := x < 10.0).any():
        shift[low] += np.log(x[low])
        x[low] += 1.0
    r = 1.0 / (x * x)
    # fixed values: Bernoulli numbers B(2k) / (2k (2k - 1))
    series = (1 / 12 + r * (-1 / 360 + r * (1 / 1260 + r * (-1 / 1680 + r * (1 / 1188 - r * 691 / 360360))))) / x
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series - shift


def _apart(x: np.ndarray) -> np.ndarray:
    """Keeps a denominator off zero."""
    return np.where(np.abs(x) > _TINY, x, _TINY)


def _fraction(first: np.ndarray, step: Callable) -> np.ndarray:
    """Continued fraction 1 / (first + n1 / (d1 + n2 / (d2 + ...))) of each row by Lentz's method.

    ``step(m, rows)`` lists the (numerator, denominator) pairs of round m for the rows that still move.
    """
    d = 1.0 / _apart(first)
    c, out = np.full_like(d, 1.0 / _TINY), d.copy()
    rows = np.arange(len(d))
    for m in range(1, STEPS):
        for over, under in step(m, rows):
            d, c = 1.0 / _apart(under + over * d), _apart(under + over / c)
            out[rows] *= d * c
        moves = np.abs(d * c - 1.0) >= 1e-15
        rows, d, c = rows[moves], d[moves], c[moves]
        if not len(rows):
            break
    return out


def _beta_tail(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Incomplete beta function on the side of its mean where the fraction is short; y = 1 - x."""
    front = np.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * np.log(x) + b * np.log(y))

    def step(m, rows):
        a_, b_, x_, j = a[rows], b[rows], x[rows], m - 1
        yield -(a_ + j) * (a_ + b_ + j) * x_ / ((a_ + 2 * j) * (a_ + 2 * j + 1)), 1.0
        yield m * (b_ - m) * x_ / ((a_ + 2 * m - 1) * (a_ + 2 * m)), 1.0

    return front * _fraction(np.ones_like(x), step) / a


def beta_inc(a, b, x, y=None) -> np.ndarray:
    """Regularised incomplete beta function; ``y`` gives 1 - x where it is known better than by subtraction."""
    x = np.atleast_1d(np.asarray(x, dtype=float))
    y = 1.0 - x if y is None else np.atleast_1d(np.asarray(y, dtype=float))
    a, b, x, y = np.broadcast_arrays(np.asarray(a, dtype=float), np.asarray(b, dtype=float), x, y)
    out = np.where((x > 0) & (y <= 0), 1.0, np.where(np.isnan(x + y), np.nan, 0.0))
    inside = (x > 0) & (y > 0)
    left = inside & (x < (a + 1.0) / (a + b + 2.0))
    right = inside & ~left
    out[left] = _beta_tail(a[left], b[left], x[left], y[left])
    out[right] = 1.0 - _beta_tail(b[right], a[right], y[right], x[right])
    return out


def gamma_upper(a, x) -> np.ndarray:
    """Regularised upper incomplete gamma function."""
    a, x = np.broadcast_arrays(np.asarray(a, dtype=float), np.atleast_1d(np.asarray(x, dtype=float)))
    out = np.where(x <= 0.0, 1.0, np.where(np.isnan(x), np.nan, 0.0))
    inside = (x > 0.0) & np.isfinite(x)
    low, high = inside & (x < a + 1.0), inside & (x >= a + 1.0)

    def front(rows):
        return np.exp(a[rows] * np.log(x[rows]) - x[rows] - log_gamma(a[rows]))

    al, xl = a[low], x[low]
    acc, term, rows = 1.0 / al, 1.0 / al, np.arange(len(al))
    for n in range(1, STEPS):
        term = term * xl[rows] / (al[rows] + n)
        acc[rows] += term
        moves = term > acc[rows] * 1e-16
        rows, term = rows[moves], term[moves]
        if not len(rows):
            break
    out[low] = 1.0 - front(low) * acc
    ah, xh = a[high], x[high]
    out[high] = front(high) * _fraction(xh + 1.0 - ah, lambda i, rows: [(-i * (i - ah[rows]), xh[rows] + 1.0 - ah[rows] + 2.0 * i)])
    return out


def f_upper(f, d1, d2) -> np.ndarray:
    f, d1, d2 = np.broadcast_arrays(*(np.atleast_1d(np.asarray(v, dtype=float)) for v in (f, d1, d2)))
    g = np.maximum(f, 0.0) * d1
    with np.errstate(invalid="ignore"):
        return np.where(np.isinf(g), 0.0, beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + g), np.where(np.isinf(g), 1.0, g / (d2 + g))))


def student_two_sided(t, df) -> np.ndarray:
    return f_upper(np.square(np.asarray(t, dtype=float)), 1.0, df)


def chi2_upper(x, k) -> np.ndarray:
    return gamma_upper(np.asarray(k, dtype=float) / 2.0, np.asarray(x, dtype=float) / 2.0)


def normal_two_sided(z) -> np.ndarray:
    return chi2_upper(np.square(np.asarray(z, dtype=float)), 1.0)


def normal_quantile(p: float) -> float:
    return -math.inf if p <= 0 else math.inf if p >= 1 else NormalDist().inv_cdf(p)


def normal_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def mann_whitney_shares(n1: int, n2: int) -> np.ndarray:
    """P(U <= u) for u up to the middle, without ties.

    The counts are Gaussian binomial coefficients, made one element of the smaller sample at a time; symmetry leaves
    the lower half, 4 n1 n2 bytes in floats.  Small tails only add, so that they keep all their digits.
    """
    n1, n2 = sorted((int(n1), int(n2)))
    half = n1 * n2 // 2 + 1
    counts = np.zeros(half)
    counts[0] = 1.0
    for i in range(1, n1 + 1):
        # divided by (1 - q^i): sums over every i-th count; then times (1 - q^(n2+i))
        rows = -(-half // i)
        sums = np.pad(counts, (0, rows * i - half)).reshape(rows, i).cumsum(axis=0).ravel()[:half]
        counts = sums.copy()
        counts[n2 + i :] -= sums[: max(half - n2 - i, 0)]
    return np.cumsum(counts) / float(math.comb(n1 + n2, n1))


def mann_whitney_exact(u, n1, n2) -> np.ndarray:
    """Two-sided exact p of U without ties."""
    u, n1, n2 = np.broadcast_arrays(*(np.atleast_1d(np.asarray(v, dtype=float)) for v in (u, n1, n2)))
    lower = np.floor(np.minimum(u, n1 * n2 - u) + 1e-9).astype(int)
    return _by_size(lower, np.minimum(n1, n2), np.maximum(n1, n2), mann_whitney_shares)


def signed_rank_shares(n: int, _=0) -> np.ndarray:
    """P(W <= w) of the signed-rank sum without ties; the counts are exact in floats up to 53 pairs."""
    counts = np.zeros(int(n) * (int(n) + 1) // 2 + 1)
    counts[0] = 1.0
    for r in range(1, int(n) + 1):
        counts[r:] = counts[r:] + counts[:-r]
    return np.cumsum(counts) / 2.0 ** int(n)


def signed_rank_exact(w, n) -> np.ndarray:
    """Two-sided exact p of the smaller signed-rank sum without ties."""
    w, n = np.broadcast_arrays(*(np.atleast_1d(np.asarray(v, dtype=float)) for v in (w, n)))
    return _by_size(np.floor(w + 1e-9).astype(int), n, np.zeros_like(n), signed_rank_shares)


def _by_size(lower: np.ndarray, n1: np.ndarray, n2: np.ndarray, shares: Callable) -> np.ndarray:
    """Twice the share at ``lower``, with one distribution per pair of sizes."""
    out = np.zeros(len(lower))
    for size in set(zip(n1.tolist(), n2.tolist(), strict=True)):
        rows = (n1 == size[0]) & (n2 == size[1])
        out[rows] = np.minimum(1.0, 2.0 * shares(*size)[lower[rows]])
    return out


def _batched(func: Callable):
    """A function of whole batches; rows with a null or nan among the arguments stay null."""

    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        args = [s.to_numpy(dtype=float, na_value=np.nan) for s in (a, b, c)]
        known = ~np.isnan(args[0] + args[1] + args[2])
        out = np.full(len(known), np.nan)
        if known.any():
            out[known] = func(*(v[known] for v in args))
        return pd.Series(out).astype(object).where(known, None).astype("Float64")

    return run


_FISHER = _batched(f_upper)
_CHI2 = _batched(lambda x, k, _: chi2_upper(x, k))
_MWU = _batched(mann_whitney_exact)
_WSR = _batched(lambda w, n, _: signed_rank_exact(w, n))


def p_fisher(f: Column, d1: Column, d2: Column) -> Column:
    return _FISHER(f, d1.cast("double"), d2.cast("double"))


def p_student(t: Column, df: Column) -> Column:
    return _FISHER(t * t, F.lit(1.0), df.cast("double"))


def p_chi2(x: Column, k: Column) -> Column:
    return _CHI2(x, k.cast("double"), F.lit(0.0))


def p_normal(z: Column) -> Column:
    return _CHI2(z * z, F.lit(1.0), F.lit(0.0))


def p_mann_whitney_exact(u: Column, n1: Column, n2: Column) -> Column:
    return _MWU(u, n1.cast("double"), n2.cast("double"))


def p_signed_rank_exact(w: Column, n: Column) -> Column:
    return _WSR(w, n.cast("double"), F.lit(0.0))
