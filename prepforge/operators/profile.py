"""Profiling: describe, missing report, counts, rates, box statistics,
crosstab shares, group averages, correlations, top-k.

Every report is one aggregation over all requested columns (wide row) that
is then unpivoted, or a ``groupBy`` over an unpivoted frame; no per-column
job loops.  Quartiles are exact (linear interpolation, by bracketing, see
:mod:`prepforge.plans.prefix`) by default; ``approx=True`` asks for
``percentile_approx``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prepforge.functions.stats import column_stats


def _q(c, p, approx):
    return F.percentile_approx(c, p, 10000) if approx else F.percentile(c, p)


def _with_quantiles(long, keys, base_aggs, qnames, approx):
    """``base_aggs`` per key group joined with quartiles per key group.  Exact
    quartiles come from grouped counts and bucketed running sums (no value
    map per group in one task); ``approx`` uses ``percentile_approx``."""
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    if approx:
        return long.groupBy(*keys).agg(*base_aggs, *[_q("x", probs[n], True).alias(qnames[n])
                                                       for n in qnames])
    from prepforge.plans.prefix import exact_quantiles, null_safe_join
    q = exact_quantiles(long, "x", [probs[n] for n in qnames], keys)
    # null is a group of its own
    piv = q.groupBy(*keys).agg(*[F.max(F.when(F.col("p") == probs[n], F.col("q"))).alias(qnames[n])
                                 for n in qnames])
    return null_safe_join(long.groupBy(*keys).agg(*base_aggs), piv, keys, "left")


def _as_double(df: DataFrame, cols, keep=()):
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])


def describe_numeric(df: DataFrame, cols, approx: bool = False, group_col: str | None = None,
                     digits: int | None = 6) -> DataFrame:
    """count, mean, std (ddof 1), min, 25/50/75 % and max per column. Without groups the columns are aggregated
    side by side, in one scan and two for the quantiles; the result has one row a column."""
    if not group_col and not approx:
        names = {"count": "count", "mean": "mean", "std": "std", "min": "min", "p25": "q1", "p50": "median", "p75": "q3", "max": "max"}
        st = column_stats(_as_double(df, cols), cols, list(names.values()))
        rows = [(c, int(st[c]["count"] or 0), *[st[c][v] for k, v in names.items() if k != "count"]) for c in cols]
        out = df.sparkSession.createDataFrame(rows, "var string, count long, " + ", ".join(f"{k} double" for k in names if k != "count"))
        return out if digits is None else out.withColumns({k: F.round(k, digits) for k in names if k != "count"})
    keep = [group_col] if group_col else []
    long = _as_double(df, cols, keep).unpivot(keep, list(cols), "var", "x")
    g = ["var"] + keep
    out = _with_quantiles(long, g, [F.count("x").alias("count"), F.avg("x").alias("mean"),
                                    F.stddev_samp("x").alias("std"), F.min("x").alias("min"),
                                    F.max("x").alias("max")],
                          {"p25": "p25", "p50": "p50", "p75": "p75"}, approx)
    if digits is not None:
        out = out.withColumns({c: F.round(c, digits) for c in
                               ["mean", "std", "min", "p25", "p50", "p75", "max"]})
    return out


def describe_by_group(df: DataFrame, cols, group_col: str, approx: bool = False) -> DataFrame:
    return describe_numeric(df, cols, approx, group_col=group_col)


def missing_report(df: DataFrame, cols=None) -> DataFrame:
    """Per column with at least one null: count and share of nulls."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot("__n", cols, "var", "n_missing")
    return (long.where(F.col("n_missing") > 0)
            .select("var", F.col("n_missing").cast("long").alias("n_missing"),
                    F.round(F.col("n_missing") / F.col("__n"), 6).alias("p_missing")))


def value_counts(df: DataFrame, c: str) -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))


def response_rate(df: DataFrame, label_col: str) -> DataFrame:
    return df.agg(F.round(100 * F.avg(label_col), 2).alias("response_pct"),
                  F.count_if(F.col(label_col) == 1).alias("n_pos"),
                  F.count_if(F.col(label_col) == 0).alias("n_neg"))


def five_number_by_label(df: DataFrame, cols, label_col: str, approx: bool = False,
                         digits: int = 6) -> DataFrame:
    long = _as_double(df, cols, [label_col]).unpivot([label_col], list(cols), "var", "x")
    out = _with_quantiles(long, ["var", label_col], [F.min("x").alias("min"), F.max("x").alias("max")],
                          {"p25": "q1", "p50": "median", "p75": "q3"}, approx)
    return out.select("var", label_col, *[F.round(c, digits).alias(c)
                                          for c in ["min", "q1", "median", "q3", "max"]])


def crosstab_shares(df: DataFrame, cat_col: str, label_col: str, digits: int = 6) -> DataFrame:
    """Contingency of category x label with an ``__all__`` margin row, the
    positive share per category and its ratio to the overall share."""
    base = df.select(F.col(cat_col).cast("string").alias(cat_col), label_col)
    g = base.rollup(cat_col).agg(
        F.grouping(cat_col).alias("__g"),
        F.count_if(F.col(label_col) == 0).alias("n0"),
        F.count_if(F.col(label_col) == 1).alias("n1"),
        F.count(F.lit(1)).alias("total"))
    g = g.withColumn(cat_col, F.when(F.col("__g") == 1, F.lit("__all__")).otherwise(F.col(cat_col)))
    share = F.col("n1") / F.col("total")
    # the rollup result has (#categories + 1) rows, so one window over it is cheap
    overall = F.max(F.when(F.col("__g") == 1, share)).over(Window.partitionBy())
    return (g.withColumn("__mean", overall)
            .select(cat_col, "n0", "n1", "total", F.round(share, digits).alias("share1"),
                    F.round(F.try_divide(share, F.col("__mean")), digits).alias("share_vs_mean")))


def group_average(df: DataFrame, key: str, metrics, digits: int = 6) -> DataFrame:
    return df.groupBy(key).agg(*[F.round(F.avg(m), digits).alias(m) for m in metrics])


def _corr(a: str, b: str) -> F.Column:
    """Pearson r over the rows where both are known, from centred one-pass moments; null if
    either is constant on them."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    vx, vy = F.var_pop(F.when(y.isNotNull(), x)), F.var_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), F.sqrt(vx) * F.sqrt(vy))


def corr_with_label(df: DataFrame, cols, label_col: str, digits: int = 6) -> DataFrame:
    """|Pearson r| of each feature with the label from one aggregation; null for a constant."""
    wide = df.agg(*[_corr(c, label_col).alias(c) for c in cols])
    long = wide.unpivot([], list(cols), "var", "r")
    return long.select("var", F.round(F.abs("r"), digits).alias("abs_corr"))


def corr_matrix(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    """|r| for every pair i <= j, long form: one aggregation of d(d+1)/2 correlations, each over
    the rows where both columns are known (as pandas does); null if one of them is constant."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    parts = []
    for s in range(0, len(pairs), 100):  # keeps the generated code of one aggregation small
        names = {f"p{s + i}": p for i, p in enumerate(pairs[s:s + 100])}
        wide = df.agg(*[_corr(a, b).alias(n) for n, (a, b) in names.items()])
        stack = ", ".join(f"'{a}', '{b}', {n}" for n, (a, b) in names.items())
        parts.append(wide.selectExpr(f"stack({len(names)}, {stack}) AS (var1, var2, r)"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("var1", "var2", F.round(F.abs("r"), digits).alias("abs_corr"))


def top_k(df: DataFrame, c: str, k: int, id_col: str = "id", extra=()) -> DataFrame:
    """Top ``k`` rows by ``c`` (ties broken by key): a TakeOrderedAndProject,
    each task keeps only k rows before the final merge."""
    return df.select(id_col, c, *extra).orderBy(F.col(c).desc(), F.col(id_col)).limit(k)
