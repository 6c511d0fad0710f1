"""Univariate outlier detectors, the vote ensemble and IQR smoothing.

Detectors return long rows ``(id, var[, score])``: one row per flagged
(row, column).  Whole-row detectors (multivariate ones) return ``(id)`` and
enter the ensemble as ``var = 'multi/unknown'``.  Column statistics are one
aggregation over all columns; they enter the flagging pass as literals, so
every detector is two scans with no shuffle except the final grouping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepforge.functions.stats import column_stats

MULTI = "multi/unknown"


def _long(df: DataFrame, exprs: dict, id_col: str, name: str = "x") -> DataFrame:
    return df.select(id_col, *[e.alias(k) for k, e in exprs.items()]) \
        .unpivot([id_col], list(exprs), "var", name)


def outlier_std_null(df: DataFrame, cols, n_std: float = 3.0) -> DataFrame:
    """Values outside mean +/- n_std * sd (ddof 1) become null."""
    st = column_stats(df, cols, ["mean", "std"])
    new = {}
    for c in cols:
        m, s = st[c]["mean"], st[c]["std"]
        if m is None or s is None:
            continue
        lo, hi = m - n_std * s, m + n_std * s
        new[c] = F.when((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi)), F.lit(None)) \
            .otherwise(F.col(c))
    return df.withColumns(new)


def _z_exprs(df, cols):
    st = column_stats(df, cols, ["mean", "std_pop"])
    return {c: (F.col(c).cast("double") - F.lit(st[c]["mean"])) / F.lit(st[c]["std_pop"])
            for c in cols if st[c]["std_pop"]}


def outlier_zscore(df: DataFrame, cols, threshold: float = 3.0, id_col: str = "id") -> DataFrame:
    """(id, var, score) where |(x - mean) / sd_pop| > threshold."""
    z = _long(df, _z_exprs(df, cols), id_col, "score")
    return z.where(F.abs("score") > threshold)


def _box_flags(df, cols, t, id_col):
    zx = _z_exprs(df, cols)
    zdf = df.select(id_col, *[e.alias(c) for c, e in zx.items()])
    q = column_stats(zdf, list(zx), ["q1", "q3"])
    parts = {}
    for c in zx:
        q1, q3 = q[c]["q1"], q[c]["q3"]
        iqr = q3 - q1
        hi, lo = q3 + t * iqr, q1 - t * iqr
        z = F.col(c)
        parts[c] = F.when(z > F.lit(hi), z - F.lit(hi)).when(z < F.lit(lo), F.lit(lo) - z)
    return _long(zdf, parts, id_col, "dist").where(F.col("dist").isNotNull())


def outlier_boxplot_all(df: DataFrame, cols, threshold: float = 1.5, id_col: str = "id") -> DataFrame:
    """Every (id, var, dist) outside the z-score box fences Q1 - t*IQR .. Q3 + t*IQR,
    with the distance to the crossed fence."""
    return _box_flags(df, cols, threshold, id_col)


def outlier_boxplot(df: DataFrame, cols, percent: float = 0.03, threshold: float = 1.5,
                    id_col: str = "id") -> DataFrame:
    """Keys of the top ``int(n * percent)`` flags by fence distance (ties by key, var).

    The top share grows with the data, so it is cut exactly by
    :func:`prepforge.plans.prefix.top_n_exact` (a cut value from a bucketed
    running sum, then a bucketed rank inside the tie group), never by a
    single-task ``limit`` of millions of rows."""
    from prepforge.plans.prefix import top_n_exact, written
    n = int(df.count() * percent)
    flags = written(_box_flags(df, cols, threshold, id_col), "boxflags")  # read by the cut, the filter and the ties
    return top_n_exact(flags, "dist", [id_col, "var"], n).select(id_col).distinct()


def outlier_robust_z(df: DataFrame, cols, threshold: float = 5.0, id_col: str = "id") -> DataFrame:
    """(id, var) where |0.6745 (x - median) / MAD| > threshold; with MAD = 0 a
    value off the median is flagged (infinite score), one on it is not."""
    med = column_stats(df, cols, ["median"])
    dev = df.select(*[F.abs(F.col(c).cast("double") - F.lit(med[c]["median"])).alias(c)
                      for c in cols if med[c]["median"] is not None])
    mad = column_stats(dev, [c for c in cols if med[c]["median"] is not None], ["median"])
    parts = {}
    for c in cols:
        if med[c]["median"] is None:
            continue
        d = F.col(c).cast("double") - F.lit(med[c]["median"])
        m = mad[c]["median"]
        parts[c] = (d != 0) if m == 0 else (F.abs(F.lit(0.6745) * d / F.lit(m)) > threshold)
    return _long(df, parts, id_col, "flag").where("flag").select(id_col, "var")


def outlier_iqr_scores(df: DataFrame, score_col: str, id_col: str = "id",
                       threshold: float = 1.5) -> DataFrame:
    """Keys whose score lies strictly outside Q1 - t*IQR .. Q3 + t*IQR."""
    q = column_stats(df, [score_col], ["q1", "q3"])[score_col]
    iqr = q["q3"] - q["q1"]
    s = F.col(score_col)
    return df.where((s > q["q3"] + threshold * iqr) | (s < q["q1"] - threshold * iqr)).select(id_col)


# ------------------------------------------------------------------ ensemble
def per_column_flags(detector: str, flags: DataFrame, id_col: str = "id") -> DataFrame:
    return flags.select(F.lit(detector).alias("detector"), id_col, F.col("var").cast("string"))


def whole_row_flags(detector: str, ids: DataFrame, id_col: str = "id") -> DataFrame:
    return ids.select(F.lit(detector).alias("detector"), id_col, F.lit(MULTI).alias("var"))


def outlier_votes(flags: DataFrame, id_col: str = "id") -> DataFrame:
    """Votes per key (one per flagged column per detector, one per whole-row
    detector) and the min-max scaled vote (0 when all counts are equal)."""
    v = flags.groupBy(id_col).agg(F.count(F.lit(1)).alias("votes"))
    mm = v.agg(F.min("votes").alias("lo"), F.max("votes").alias("hi")).first()
    lo, hi = (mm["lo"] or 0), (mm["hi"] or 0)
    scaled = (F.col("votes") - F.lit(lo)).cast("double") / F.lit(float(hi - lo)) if hi > lo \
        else F.lit(0.0)
    return v.withColumn("score", scaled)


def outlier_info(flags: DataFrame, id_col: str = "id") -> DataFrame:
    """Per key, the sorted distinct flagged columns (bounded by the column count)."""
    return flags.groupBy(id_col).agg(
        F.array_join(F.sort_array(F.collect_set("var")), ",").alias("vars"))


def outlier_vote_drop(df: DataFrame, votes: DataFrame, threshold: float,
                      id_col: str = "id") -> DataFrame:
    bad = votes.where(F.col("score") > threshold).select(id_col)
    return df.join(bad, id_col, "left_anti")


def outlier_vote_info(flags: DataFrame, votes: DataFrame, threshold: float,
                      id_col: str = "id") -> DataFrame:
    keep = votes.where(F.col("score") > threshold).select(id_col)
    return outlier_info(flags.join(keep, id_col, "left_semi"), id_col)


def outlier_smooth(df: DataFrame, flags: DataFrame, votes: DataFrame, threshold: float,
                   cols, id_col: str = "id") -> DataFrame:
    """For keys voted above ``threshold``: a flagged value is clamped to
    Q3 + 1.5 IQR when it is above the column mean, else to Q1 - 1.5 IQR; a key
    flagged by a whole-row detector is removed.  Statistics come from ``df``."""
    cols = list(cols)
    sel = flags.join(votes.where(F.col("score") > threshold).select(id_col), id_col, "left_semi")
    multi = sel.where(F.col("var") == MULTI).select(id_col).distinct()
    per = (sel.where(F.col("var").isin(cols)).groupBy(id_col)
           .pivot("var", cols).agg(F.count(F.lit(1))))
    st = column_stats(df, cols, ["mean", "q1", "q3"])
    out = df.join(multi, id_col, "left_anti").join(per.withColumnsRenamed(
        {c: f"__f_{c}" for c in cols}), id_col, "left")
    dt = dict(df.dtypes)
    new = {}
    for c in cols:
        m, q1, q3 = st[c]["mean"], st[c]["q1"], st[c]["q3"]
        iqr = q3 - q1
        clamp = F.when(F.col(c) > F.lit(m), F.lit(q3 + 1.5 * iqr)).otherwise(F.lit(q1 - 1.5 * iqr))
        new[c] = F.when(F.coalesce(F.col(f"__f_{c}"), F.lit(0)) > 0, clamp) \
            .otherwise(F.col(c).cast("double")) if dt[c] != "double" else \
            F.when(F.coalesce(F.col(f"__f_{c}"), F.lit(0)) > 0, clamp).otherwise(F.col(c))
    return out.withColumns(new).drop(*[f"__f_{c}" for c in cols])
