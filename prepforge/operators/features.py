"""Business features, non-finite cleanup, power transforms, uniform bins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepforge.functions.exprs import (POWER_TRANSFORMS, finite_or_null, minmax_expr,
                                       power_expr, power_suffix, safe_ratio,
                                       uniform_bin_expr)
from prepforge.functions.stats import column_stats


@dataclass(frozen=True)
class BusinessColumns:
    """Source column names the derived set reads (defaults: the c360 view)."""
    web: str = "num_web"
    catalog: str = "num_catalog"
    store: str = "num_store"
    visits: str = "num_web_visits"
    year_birth: str = "year_birth"
    campaigns: tuple = ("accepted_cmp1", "accepted_cmp2", "accepted_cmp3",
                        "accepted_cmp4", "accepted_cmp5")
    spend: tuple = ("mnt_wines", "mnt_fruits", "mnt_meat", "mnt_fish", "mnt_sweet", "mnt_gold")
    income: str = "income"
    kids: str = "kidhome"
    teens: str = "teenhome"
    marital: str = "marital_status"


# The household rule counts two adults for these statuses.
COUPLE_STATUSES = ["Together", "Married"]
SPEND_RATIO_NAMES = ["ratio_wines", "ratio_fruits", "ratio_meat", "ratio_fish",
                     "ratio_sweet", "ratio_gold"]
BUSINESS_FEATURES = ["web_purchases_per_visit", "total_purchases", "ratio_web_purchases",
                     "ratio_catalog_purchases", "ratio_store_purchases", "age",
                     "total_accepted_campaigns", "total_money_spent"] + SPEND_RATIO_NAMES + [
                     "money_per_purchase", "income_2years", "effort_rate", "total_kids",
                     "count_household", "income_per_person"]


def business_features(df: DataFrame, ref_year: int, cols: BusinessColumns = BusinessColumns(),
                      marital_col: str | None = None) -> DataFrame:
    """The reference's derived set as one projection (two ``withColumns`` levels
    that CollapseProject fuses).  Divisions are safe ratios: 0 where the
    denominator is 0 and where the result is null or non-finite."""
    c = cols
    marital = F.col(marital_col or c.marital)
    lvl1 = {
        "web_purchases_per_visit": safe_ratio(c.web, c.visits),
        "total_purchases": F.col(c.web) + F.col(c.catalog) + F.col(c.store),
        "age": (F.lit(ref_year) - F.col(c.year_birth)).cast("int"),
        "total_accepted_campaigns": sum((F.col(x).cast("int") for x in c.campaigns[1:]),
                                        F.col(c.campaigns[0]).cast("int")),
        "total_money_spent": sum((F.col(x) for x in c.spend[1:]), F.col(c.spend[0])),
        "income_2years": F.col(c.income) * 2,
        "total_kids": F.col(c.kids) + F.col(c.teens),
    }
    out = df.withColumns(lvl1)
    lvl2 = {
        "ratio_web_purchases": safe_ratio(c.web, "total_purchases"),
        "ratio_catalog_purchases": safe_ratio(c.catalog, "total_purchases"),
        "ratio_store_purchases": safe_ratio(c.store, "total_purchases"),
        **{n: safe_ratio(s, "total_money_spent") for n, s in zip(SPEND_RATIO_NAMES, c.spend)},
        "money_per_purchase": safe_ratio("total_money_spent", "total_purchases"),
        "effort_rate": safe_ratio("total_money_spent", "income_2years"),
        "count_household": (F.when(F.coalesce(marital.isin(COUPLE_STATUSES), F.lit(False)), 2)
                            .otherwise(1) + F.col("total_kids")).cast("int"),
    }
    out = out.withColumns(lvl2)
    return out.withColumn("income_per_person", safe_ratio("income_2years", "count_household"))


def fill_nonfinite(df: DataFrame, cols=None, value: float = 0.0) -> DataFrame:
    """+/-inf and NaN -> null -> ``value`` over the numeric columns."""
    from prepforge.functions.exprs import numeric_columns
    cols = cols or numeric_columns(df)
    dt = dict(df.dtypes)
    new = {}
    for c in cols:
        if dt[c] in ("float", "double"):
            new[c] = F.coalesce(finite_or_null(c), F.lit(value))
        else:
            new[c] = F.coalesce(F.col(c), F.lit(value).cast(dt[c]))
    return df.withColumns(new)


def power_features(df: DataFrame, cols, digits: int = 4) -> DataFrame:
    """Seven transforms per column, named ``<col>__<t>``."""
    return df.withColumns({f"{c}__{power_suffix(t)}": power_expr(c, t, digits)
                           for c in cols for t in POWER_TRANSFORMS})


@dataclass
class UniformBins:
    bounds: dict[str, tuple[float, float]]
    n_bins: int = 10

    def transform(self, df: DataFrame, suffix: str = "_bin") -> DataFrame:
        return df.withColumns({f"{c}{suffix}": uniform_bin_expr(c, lo, hi, self.n_bins)
                               for c, (lo, hi) in self.bounds.items()})


def fit_uniform_bins(df: DataFrame, cols, n_bins: int = 10) -> UniformBins:
    st = column_stats(df, cols, ["min", "max"])
    return UniformBins({c: (st[c]["min"], st[c]["max"]) for c in cols}, n_bins)


@dataclass
class PowerChoice:
    """Per feature: min-max bounds fitted on train and the chosen transform."""
    scale: dict[str, tuple[float, float]]
    best: dict[str, str]
    digits: int = 4
    prefix: str = "bxcx_"

    def transform(self, df: DataFrame) -> DataFrame:
        new = {}
        for c, (lo, hi) in self.scale.items():
            new[f"{self.prefix}{c}"] = power_expr(minmax_expr(c, lo, hi), self.best[c], self.digits)
        return df.withColumns(new)


def fit_best_power(df: DataFrame, cols, label_col: str, n_bins: int = 10,
                   digits: int = 4) -> tuple[PowerChoice, DataFrame]:
    """Min-max each feature, try the seven transforms, bin each in 10 equal
    widths, and keep the transform with the largest chi-square against the
    label (compared at 9 digits; first in the fixed order on ties).  All
    features x transforms are scored by aggregations over one unpivoted frame;
    the per-key bounds table has 7 x d rows and is broadcast."""
    from prepforge.operators.select import chi2_long
    st = column_stats(df, cols, ["min", "max"])
    scale = {c: (st[c]["min"], st[c]["max"]) for c in cols}
    t_cols = {}
    for c in cols:
        s = minmax_expr(c, *scale[c])
        for t in POWER_TRANSFORMS:
            t_cols[f"{c}__{power_suffix(t)}"] = power_expr(s, t, digits)
    wide = df.select(F.col(label_col), *[v.alias(k) for k, v in t_cols.items()])
    long = wide.unpivot(label_col, list(t_cols), "var", "x")
    bounds = long.groupBy("var").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    rng = F.col("hi") - F.col("lo")
    binned = long.join(F.broadcast(bounds), "var").withColumn(
        "v", F.when(rng == 0, F.lit(0)).otherwise(
            F.least(F.floor((F.col("x") - F.col("lo")) * n_bins / rng), F.lit(n_bins - 1))))
    by_suffix = {power_suffix(t): t for t in POWER_TRANSFORMS}
    scores = chi2_long(binned, label_col).select(
        F.regexp_extract("var", r"^(.*)__[^_]+$", 1).alias("feature"),
        F.regexp_extract("var", r"__([^_]+)$", 1).alias("suffix"),
        F.round("chi2", 9).alias("chi2"))
    rows = scores.collect()  # 7 x d rows
    order = {t: i for i, t in enumerate(POWER_TRANSFORMS)}
    best: dict[str, tuple[float, str]] = {}
    for r in sorted(rows, key=lambda r: (r["feature"], order[by_suffix[r["suffix"]]])):
        v = r["chi2"] if r["chi2"] is not None else float("-inf")
        cur = best.get(r["feature"])
        if cur is None or v > cur[0]:
            best[r["feature"]] = (v, by_suffix[r["suffix"]])
    model = PowerChoice(scale, {c: best[c][1] for c in cols}, digits)
    return model, scores
