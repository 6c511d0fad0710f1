"""One-pass statistics (P2) and distribution tails.

``column_stats`` builds a single ``agg`` for every (column, statistic) pair and
returns one small driver-side dict: the fitted state of a transform is a few
scalars per column, which then enter later plans as literals.  Tails (chi2,
F, t) are evaluated in a pandas UDF over result tables whose size is the
number of features, never the number of rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BATCH = 200  # columns per agg keeps generated code below the JVM method limit

_STAT = {
    "count": lambda c: F.count(c),
    "mean": lambda c: F.avg(c),
    "std": lambda c: F.stddev_samp(c),
    "std_pop": lambda c: F.stddev_pop(c),
    "var": lambda c: F.var_samp(c),
    "var_pop": lambda c: F.var_pop(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "sum": lambda c: F.sum(c),
    "nulls": lambda c: F.count_if(F.col(c).isNull()),
}
_QUANT = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def column_stats(df: DataFrame, cols, stats) -> dict[str, dict[str, float]]:
    """{col: {stat: value}} from one aggregation per batch of columns."""
    cols = list(cols)
    out: dict[str, dict[str, float]] = {c: {} for c in cols}
    qs = [s for s in stats if s in _QUANT]
    if qs and cols:
        # exact, by bracketing
        from prepforge.plans.prefix import wide_quantiles
        got = wide_quantiles(df, cols, [_QUANT[s] for s in qs])
        for c in cols:
            for s_ in qs:
                v = got.get((c, _QUANT[s_]))
                out[c][s_] = None if v is None else float(v)
    stats = [s for s in stats if s not in _QUANT]
    pairs = [(c, s) for c in cols for s in stats]
    for i in range(0, len(pairs), _BATCH):
        chunk = pairs[i:i + _BATCH]
        row = df.agg(*[_STAT[s](c).alias(f"{j}") for j, (c, s) in enumerate(chunk)]).first()
        for j, (c, s) in enumerate(chunk):
            v = row[j]
            out[c][s] = None if v is None else float(v)
    return out


# ---------------------------------------------------------------- tails
def _gammainc_upper_reg(a: float, x: float) -> float:
    """Q(a, x), regularised upper incomplete gamma (series / continued fraction)."""
    if x <= 0:
        return 1.0
    if x < a + 1:
        ap, s, d = a, 1.0 / a, 1.0 / a
        for _ in range(1000):
            ap += 1
            d *= x / ap
            s += d
            if abs(d) < abs(s) * 1e-15:
                break
        return max(0.0, 1.0 - s * math.exp(-x + a * math.log(x) - math.lgamma(a)))
    b, c, d = x + 1 - a, 1.0 / 1e-300, 1.0 / (x + 1 - a)
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        de = d * c
        h *= de
        if abs(de - 1) < 1e-15:
            break
    return h * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _betacf(a, b, x):
    qab, qap, qam = a + b, a + 1, a - 1
    c, d = 1.0, 1 - qab * x / qap
    d = 1e-300 if abs(d) < 1e-300 else d
    d = 1 / d
    h = d
    for m in range(1, 1000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1 + aa * d
        d = 1e-300 if abs(d) < 1e-300 else d
        c = 1 + aa / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1 + aa * d
        d = 1e-300 if abs(d) < 1e-300 else d
        c = 1 + aa / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1 / d
        de = d * c
        h *= de
        if abs(de - 1) < 1e-15:
            break
    return h


def _betainc_reg(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def chi2_sf(stat: float, dof: float) -> float:
    if stat is None or dof is None or dof <= 0 or (isinstance(stat, float) and math.isnan(stat)):
        return float("nan")
    return _gammainc_upper_reg(dof / 2.0, stat / 2.0)


def f_sf(f: float, d1: float, d2: float) -> float:
    if f is None or d1 <= 0 or d2 <= 0 or math.isnan(f):
        return float("nan")
    if f <= 0:
        return 1.0
    return _betainc_reg(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def t_sf2(t: float, dof: float) -> float:
    """Two-sided p-value of a t statistic."""
    if t is None or dof <= 0 or math.isnan(t):
        return float("nan")
    return _betainc_reg(dof / 2.0, 0.5, dof / (dof + t * t))


@F.pandas_udf(T.DoubleType())
def chi2_pvalue(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(float(s), float(d)) for s, d in zip(stat, dof)])


@F.pandas_udf(T.DoubleType())
def f_pvalue(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([f_sf(float(a), float(b), float(c)) for a, b, c in zip(f, d1, d2)])


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_sf2(float(a), float(b)) for a, b in zip(t, dof)])


def pinv(m: np.ndarray) -> np.ndarray:
    """Inverse, falling back to the least-squares inverse for a singular matrix."""
    try:
        return np.linalg.inv(m)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(m, np.eye(m.shape[0]), rcond=None)[0]


def quantile(df: DataFrame, col: str, p: float) -> float | None:
    """Exact linear-interpolation quantile of one column (distributed, see
    :func:`prepforge.plans.prefix.wide_quantiles`)."""
    from prepforge.plans.prefix import wide_quantiles
    return wide_quantiles(df, [col], [p])[col, float(p)]
