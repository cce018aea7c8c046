"""Gamma distribution pieces of the drought index.

The shape is solved from two sufficient statistics with a handful of Newton
steps, all inside one native expression.  Only the distribution function and
the normal quantile, which Spark lacks, run as an Arrow-batched function.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

# Executors need not have this package installed: the functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NEWTON_STEPS = 8
RECURRENCE_SHIFT = 8  # lift the argument before using the asymptotic series
LARGE_SHAPE = 1e5
MOST_STEPS = 20_000  # of a series or fraction; shapes up to LARGE_SHAPE settle in a few thousand
# Coefficients of AS 241 (numerator, denominator; lowest power first) around the middle, and for the near and far tail.
CENTRAL = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4,
     6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4, 3.9307895800092710610e4,
     2.8729085735721942674e4, 5.2264952788528545610e3))
NEAR = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0, 1.27045825245236838258e0,
     2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1, 1.51986665636164571966e-2,
     5.47593808499534494600e-4, 1.05075007164441684324e-9))
FAR = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1, 2.65321895265761230930e-2,
     1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4, 1.84631831751005468180e-5,
     1.42151175831644588870e-7, 2.04426310338993978564e-15))


def _digamma(a: Column) -> Column:
    z = a + F.lit(float(RECURRENCE_SHIFT))
    inv2 = 1.0 / (z * z)
    tail = F.ln(z) - 0.5 / z - inv2 * (1 / 12 - inv2 * (1 / 120 - inv2 * (1 / 252 - inv2 * (1 / 240 - inv2 / 132))))
    for k in range(RECURRENCE_SHIFT):
        tail = tail - 1.0 / (a + F.lit(float(k)))
    return tail


def _trigamma(a: Column) -> Column:
    z = a + F.lit(float(RECURRENCE_SHIFT))
    inv = 1.0 / z
    inv2 = inv * inv
    out = inv + 0.5 * inv2 + inv * inv2 * (1 / 6 - inv2 * (1 / 30 - inv2 * (1 / 42 - inv2 / 30)))
    for k in range(RECURRENCE_SHIFT):
        t = a + F.lit(float(k))
        out = out + 1.0 / (t * t)
    return out


def gamma_shape(mean: Column, mean_log: Column) -> Column:
    """Maximum-likelihood shape (location fixed at 0) from avg(x) and avg(ln x).

    NULL when the data are constant: the likelihood then has no maximum.
    """
    s = F.ln(mean) - mean_log
    # Closed-form start of Minka's/Thom's kind, good to about 1.5 %.
    start = (3.0 - s + F.sqrt((s - 3.0) * (s - 3.0) + 24.0 * s)) / (12.0 * s)

    def step(a: Column, _: Column) -> Column:
        return a - (F.ln(a) - _digamma(a) - s) / (1.0 / a - _trigamma(a))

    solved = F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), start, step)
    return F.when(s > 1e-14, solved)


def _gamma_cdf(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Regularised lower incomplete gamma: series below a+1, continued fraction above, a cube-root normal beyond ``LARGE_SHAPE``.

    Values that have not settled after ``MOST_STEPS`` steps are NaN.
    """
    out = np.full(x.shape, np.nan)
    out[x <= 0] = 0.0
    shapes, which = np.unique(a, return_inverse=True)  # one log-gamma per fit, not per value
    lgam = np.array([math.lgamma(v) if v > 0 else math.nan for v in shapes.tolist()])[which]

    large = (x > 0) & (a > LARGE_SHAPE)
    if large.any():
        out[large] = [0.5 * math.erfc(-z / math.sqrt(2)) for z in _large_shape_index(x[large], a[large]).tolist()]

    low = (x > 0) & (x <= a + 1) & ~large
    if low.any():
        xs, as_ = x[low], a[low]
        term = 1.0 / as_
        total, k = term.copy(), as_.copy()
        for _ in range(MOST_STEPS):
            k += 1.0
            term *= xs / k
            total += term
            if not np.any(term > total * 1e-17):
                break
        settled = ~(term > total * 1e-16)
        out[low] = np.where(settled, np.minimum(total * np.exp(as_ * np.log(xs) - xs - lgam[low]), 1.0), np.nan)

    high = (x > a + 1) & ~large
    if high.any():
        xs, as_ = x[high], a[high]
        tiny = 1e-300
        b = xs + 1.0 - as_
        c = np.full(xs.shape, 1.0 / tiny)
        d = 1.0 / np.where(b == 0, tiny, b)
        h = d.copy()
        for i in range(1, MOST_STEPS + 1):
            an = -i * (i - as_)
            b = b + 2.0
            d = an * d + b
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = b + an / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            delta = c * d
            h = h * delta
            if not np.any(np.abs(delta - 1.0) > 1e-15):
                break
        settled = np.abs(delta - 1.0) <= 1e-12
        out[high] = np.where(settled, 1.0 - np.exp(as_ * np.log(xs) - xs - lgam[high]) * h, np.nan)
    return out


def _large_shape_index(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Normal score of a gamma value of large shape: its cube root is nearly normal (Wilson and Hilferty)."""
    return (np.cbrt(x / a) - (1.0 - 1.0 / (9.0 * a))) * 3.0 * np.sqrt(a)


def _ratio(top: tuple, bottom: tuple, r: np.ndarray) -> np.ndarray:
    return np.polyval(top[::-1], r) / np.polyval(bottom[::-1], r)


def _normal_quantile(p: np.ndarray) -> np.ndarray:
    """Rational approximations of algorithm AS 241, good to about 16 digits."""
    p = np.asarray(p, dtype=float)
    out = np.full(p.shape, np.nan)
    out[p <= 0], out[p >= 1] = -np.inf, np.inf
    q = p - 0.5
    middle = np.abs(q) <= 0.425
    out[middle] = q[middle] * _ratio(*CENTRAL, 0.180625 - q[middle] ** 2)
    outer = ~middle & (p > 0) & (p < 1)
    r = np.sqrt(-np.log(np.minimum(p[outer], 1.0 - p[outer])))
    tail = np.where(r <= 5.0, _ratio(*NEAR, r - 1.6), _ratio(*FAR, r - 5.0))
    out[outer] = np.copysign(tail, q[outer])
    return out


def gamma_cdf(x: Column, shape: Column, scale: Column) -> Column:
    @F.pandas_udf("double")
    def score(x: pd.Series, shape: pd.Series, scale: pd.Series) -> pd.Series:
        ok = (x.notna() & shape.notna() & scale.notna()).to_numpy()
        out = np.full(len(x), np.nan)
        a = shape.to_numpy(dtype=float, na_value=np.nan)[ok]
        z = (x.to_numpy(dtype=float, na_value=np.nan) / scale.to_numpy(dtype=float, na_value=np.nan))[ok]
        out[ok] = _gamma_cdf(z, a)
        return pd.Series(out).astype(object).where(ok, None)

    return score(x, shape, scale)


def normal_quantile(p: Column) -> Column:
    """Standard-normal quantile; 0 -> -inf and 1 -> +inf."""
    @F.pandas_udf("double")
    def score(p: pd.Series) -> pd.Series:
        ok = p.notna().to_numpy()
        out = _normal_quantile(p.to_numpy(dtype=float, na_value=np.nan))
        return pd.Series(out).astype(object).where(ok, None)

    return score(p)


def _index(x: np.ndarray, shape: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = x / scale
    out = _normal_quantile(_gamma_cdf(z, np.minimum(shape, LARGE_SHAPE)))
    large = (shape > LARGE_SHAPE) & (z > 0)
    out[large] = _large_shape_index(z[large], shape[large])
    return out


def standardized_index(x: Column, shape: Column, scale: Column) -> Column:
    """normal_quantile(gamma_cdf(x)) in one Arrow round trip."""
    @F.pandas_udf("double")
    def score(x: pd.Series, shape: pd.Series, scale: pd.Series) -> pd.Series:
        ok = (x.notna() & shape.notna() & scale.notna()).to_numpy()
        out = np.full(len(x), np.nan)
        out[ok] = _index(*(c[ok].to_numpy(dtype=float) for c in (x, shape, scale)))
        return pd.Series(out).astype(object).where(ok, None)

    return score(x, shape, scale)


def mean_standardized_index(values: Column, shape: Column, scale: Column) -> Column:
    """Mean index of an array of values that share one fit.

    Meant for arrays with a fixed bound (the days of a season): scoring them in
    place saves the shuffle that exploding and averaging again would need.
    """
    @F.pandas_udf("double")
    def score(values: pd.Series, shape: pd.Series, scale: pd.Series) -> pd.Series:
        counts = values.map(lambda v: 0 if v is None else len(v)).to_numpy()
        ok = (counts > 0) & (shape.notna() & scale.notna()).to_numpy()
        out = np.full(len(values), np.nan)
        if ok.any():
            n = counts[ok]
            x = np.concatenate(values[ok].to_list()).astype(float)
            z = _index(x, np.repeat(shape[ok].to_numpy(dtype=float), n), np.repeat(scale[ok].to_numpy(dtype=float), n))
            out[ok] = np.add.reduceat(z, np.concatenate(([0], np.cumsum(n)[:-1]))) / n
        return pd.Series(out).astype(object).where(ok, None)

    return score(values, shape, scale)
