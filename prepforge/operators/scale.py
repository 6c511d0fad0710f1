"""Fit / apply transforms: imputers, min-max, standard scaling, Yeo-Johnson.

``fit_*`` runs one aggregation over the training frame and returns a model
holding a few scalars per column; ``model.transform(df)`` is a pure column
projection, so it applies to any frame with those columns, including a
streaming one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepforge.functions.exprs import minmax_expr
from prepforge.functions.stats import column_stats
from prepforge.plans.prefix import written

#: Variances of one aggregation: more of them leave the generated code's limits and are interpreted.
YJ_BATCH = 24


@dataclass
class FillModel:
    values: dict
    strategy: dict

    def transform(self, df: DataFrame) -> DataFrame:
        dt = dict(df.dtypes)
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(dt[c]) if dt[c] != "double"
                                             else F.lit(float(v)))
                               for c, v in self.values.items() if v is not None})


def fit_impute_numeric(df: DataFrame, cols, strategy: str = "auto", alpha: float = 0.05) -> FillModel:
    """Mean or median per column.  ``auto``: a Kolmogorov-Smirnov test of the
    non-null values against the normal with their mean and sd chooses the
    mean when p > alpha, else the median (the test is a distributed job)."""
    st = column_stats(df, cols, ["mean", "median", "std"])
    values, chosen = {}, {}
    for c in cols:
        s = strategy
        if s == "auto":
            sd = st[c]["std"]
            if sd is None or sd == 0 or st[c]["mean"] is None:
                s = "median"
            else:
                nn = df.select(F.col(c).cast("double").alias(c)).where(F.col(c).isNotNull())
                p = KolmogorovSmirnovTest.test(nn, c, "norm", st[c]["mean"], sd).first().pValue
                s = "mean" if p > alpha else "median"
        chosen[c] = s
        values[c] = st[c][s]
    return FillModel(values, chosen)


def fit_impute_mode(df: DataFrame, cols) -> FillModel:
    """Most frequent non-null value; the smallest value wins a tie."""
    values = {}
    for c in cols:
        r = (df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.col("n").desc(), F.col(c)).limit(1).collect())
        values[c] = r[0][0] if r else None
    return FillModel(values, {c: "mode" for c in cols})


@dataclass
class MinMaxModel:
    bounds: dict[str, tuple[float, float]]

    def transform(self, df: DataFrame) -> DataFrame:
        """Not clipped on unseen rows; a constant column maps to x - min."""
        return df.withColumns({c: minmax_expr(c, lo, hi) for c, (lo, hi) in self.bounds.items()})


def fit_minmax(df: DataFrame, cols) -> MinMaxModel:
    st = column_stats(df, cols, ["min", "max"])
    return MinMaxModel({c: (st[c]["min"], st[c]["max"]) for c in cols})


@dataclass
class StandardModel:
    params: dict[str, tuple[float, float]]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s if s else 1.0)
            for c, (m, s) in self.params.items()})


def fit_standard(df: DataFrame, cols, exclude=()) -> StandardModel:
    """z-scale (population sd) the listed continuous columns; dummies pass through."""
    cols = [c for c in cols if c not in set(exclude)]
    st = column_stats(df, cols, ["mean", "std_pop"])
    return StandardModel({c: (st[c]["mean"], st[c]["std_pop"]) for c in cols})


# ------------------------------------------------------------ Yeo-Johnson
def _yj_expr(x, lam: float):
    x = F.col(x).cast("double") if isinstance(x, str) else x
    pos = x >= 0
    if abs(lam) < 1e-12:
        p = F.log1p(x)
    else:
        p = (F.pow(x + 1, F.lit(lam)) - 1) / F.lit(lam)
    if abs(lam - 2) < 1e-12:
        n = -F.log1p(-x)
    else:
        n = -(F.pow(1 - x, F.lit(2 - lam)) - 1) / F.lit(2 - lam)
    return F.when(pos, p).otherwise(n)


@dataclass
class YeoJohnsonModel:
    lambdas: dict[str, float]
    standardize: dict[str, tuple[float, float]]

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, lam in self.lambdas.items():
            m, s = self.standardize[c]
            out[c] = (_yj_expr(c, lam) - F.lit(m)) / F.lit(s if s else 1.0)
        return df.withColumns(out)


def fit_yeo_johnson(df: DataFrame, cols, grid=None, rounds: int = 3) -> YeoJohnsonModel:
    """Per-column lambda maximising the Yeo-Johnson profile log-likelihood

        llf(l) = -n/2 * log(var_pop(y_l)) + (l - 1) * sum(sign(x) * log1p(|x|))

    over the column's known values (n of them).  The (column, lambda) pairs of a grid
    are taken ``YJ_BATCH`` an aggregation over the written columns.  While a column's best value lies at an end of its grid,
    the grid moves on past that end; then it is refined around the best value
    ``rounds`` times.  A grid whose every variance is zero or beyond double range
    (a constant column) leaves lambda at 1."""
    cols = list(cols)
    grid = [float(x) for x in (grid if grid is not None else np.linspace(-3, 3, 25))]
    df = written(df.select(*dict.fromkeys(cols)), "yeojohnson")
    jac = df.agg(*[F.sum(F.signum(F.col(c)) * F.log1p(F.abs(F.col(c).cast("double")))).alias(c) for c in cols],
                 *[F.count(c).alias(f"n_{c}") for c in cols]).first()
    best: dict[str, tuple[float, float]] = {}
    cur, left = {c: grid for c in cols}, {c: rounds for c in cols}
    while cur:
        keys = [(c, lam) for c, g in cur.items() for lam in g]
        row = [v for i in range(0, len(keys), YJ_BATCH) for v in
               df.agg(*[F.var_pop(_yj_expr(c, lam)).alias(f"a{j}") for j, (c, lam) in enumerate(keys[i:i + YJ_BATCH])]).first()]
        for (c, lam), v in zip(keys, row):
            # beyond double range the likelihood has long fallen
            if v is None or not 0 < v < float("inf"):
                continue
            llf = -jac[f"n_{c}"] / 2.0 * math.log(v) + (lam - 1) * (jac[c] or 0.0)
            if c not in best or llf > best[c][1]:
                best[c] = (lam, llf)
        nxt = {}
        for c, g in cur.items():
            if c not in best:
                continue
            lam, step, width = best[c][0], g[1] - g[0] if len(g) > 1 else 0.25, g[-1] - g[0]
            if lam in (g[0], g[-1]) and width > 0 and abs(lam) < 1e3:
                s = 1 if lam == g[-1] else -1  # the optimum may lie outside: move on
                nxt[c] = sorted(lam + s * step * i for i in range(len(g)))
            elif left[c]:
                left[c] -= 1
                nxt[c] = [float(x) for x in np.linspace(lam - step, lam + step, 9)]
        cur = nxt
    lambdas = {c: best.get(c, (1.0, 0))[0] for c in cols}
    st = df.agg(*[F.avg(_yj_expr(c, lambdas[c])).alias(f"m{i}") for i, c in enumerate(cols)],
                *[F.stddev_pop(_yj_expr(c, lambdas[c])).alias(f"s{i}") for i, c in enumerate(cols)]
                ).first()
    return YeoJohnsonModel(lambdas, {c: (st[f"m{i}"], st[f"s{i}"]) for i, c in enumerate(cols)})
