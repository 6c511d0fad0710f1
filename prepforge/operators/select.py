"""Feature selection: filter rankings as aggregations, wrappers as Spark ML fits.

Filter rankings (constant, chi-square, single-feature OLS, Fisher, ANOVA F,
information gain) are computed for all features at once from an unpivoted
frame or one wide aggregation; their outputs have one row per feature.
p-values are evaluated by pandas UDFs on those per-feature rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prepforge.functions.exprs import uniform_bin_expr
from prepforge.functions.stats import (chi2_pvalue, column_stats, f_pvalue, t_pvalue)
from prepforge.plans.prefix import running_sums


def select_constant(df: DataFrame, cols, min_sd: float = 0.01) -> DataFrame:
    """Per numeric column: sample sd and whether it falls below ``min_sd``."""
    wide = df.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "var", "sd").select(
        "var", F.round("sd", 6).alias("sd"),
        F.coalesce(F.col("sd") < min_sd, F.lit(True)).alias("dropped"))


# ------------------------------------------------------------- chi-square
def chi2_long(long_df: DataFrame, label_col: str, yates: bool = True) -> DataFrame:
    """Chi-square of (value x label) per ``var`` from rows (var, v, label).

    Only observed values enter (a crosstab); with two values and two labels
    (one degree of freedom) Yates' continuity correction is applied."""
    cells = long_df.groupBy("var", "v").agg(
        F.count_if(F.col(label_col) == 1).alias("o1"),
        F.count_if(F.col(label_col) == 0).alias("o0"))
    tot = cells.groupBy("var").agg(F.sum("o1").alias("t1"), F.sum("o0").alias("t0"),
                                   F.count(F.lit(1)).alias("nv"))
    j = cells.join(tot, "var")
    n = F.col("t1") + F.col("t0")
    rt = (F.col("o1") + F.col("o0")).cast("double")  # a product of two counts passes bigint
    labels_present = (F.col("t1") > 0).cast("int") + (F.col("t0") > 0).cast("int")
    dof = (F.col("nv") - 1) * (labels_present - 1)

    def term(o, e):
        d = F.abs(F.col(o) - e)
        if yates:
            d = F.when(dof == 1, F.greatest(d - F.least(F.lit(0.5), d), F.lit(0.0))).otherwise(d)
        return F.when(e > 0, d * d / e).otherwise(F.lit(0.0))

    t = term("o1", rt * F.col("t1") / n) + term("o0", rt * F.col("t0") / n)
    return j.groupBy("var").agg(F.sum(t).alias("chi2"), F.first(dof).alias("dof"))


def rank_chi2(df: DataFrame, continuous, categorical, label_col: str, n_bins: int = 10,
              digits: int = 6) -> DataFrame:
    """(var, chi2, dof, rank): continuous columns are cut in ``n_bins`` equal
    widths on their min-max range, categorical columns are used as they are."""
    continuous, categorical = list(continuous), list(categorical)
    st = column_stats(df, continuous, ["min", "max"]) if continuous else {}
    wide = df.select(F.col(label_col),
                     *[uniform_bin_expr(c, st[c]["min"], st[c]["max"], n_bins).cast("double").alias(c)
                       for c in continuous],
                     *[F.col(c).cast("double").alias(c) for c in categorical])
    long = wide.unpivot([label_col], continuous + categorical, "var", "v")
    res = chi2_long(long, label_col).withColumn("chi2", F.round("chi2", digits))
    w = Window.orderBy(F.col("chi2").desc(), F.col("var"))  # one row per feature
    return res.select("var", "chi2", F.col("dof").cast("long"), F.row_number().over(w).alias("rank"))


def chi2_pvalues(ranked: DataFrame, alpha: float = 0.05) -> DataFrame:
    p = chi2_pvalue(F.col("chi2"), F.col("dof").cast("double"))
    return ranked.withColumn("p_value", p).withColumn("valid", F.col("p_value") <= alpha)


# ------------------------------------------------------ single-feature OLS
def rank_linear(df: DataFrame, cols, label_col: str, digits: int = 6,
                with_p: bool = False) -> DataFrame:
    """OLS of the label on each single feature without intercept: coefficient,
    standard error, t and uncentred adjusted R^2, from one wide aggregation."""
    y = F.col(label_col).cast("double")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(y * y).alias("syy")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.sum(x * y).alias(f"sxy{i}"), F.sum(x * x).alias(f"sxx{i}")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', sxy{i}, sxx{i}" for i, c in enumerate(cols))
    long = wide.selectExpr(f"stack({len(cols)}, {stack}) AS (var, sxy, sxx)", "n", "syy")
    coef = F.try_divide(F.col("sxy"), F.col("sxx"))
    out = long.withColumn("coef", coef)
    rss = F.col("syy") - F.col("coef") * F.col("sxy")
    out = out.withColumn("rss", rss)
    se = F.sqrt(F.try_divide(F.col("rss"), (F.col("n") - 1) * F.col("sxx")))
    r2 = 1 - F.try_divide(F.col("rss"), F.col("syy"))
    out = out.withColumns({"std_err": se,
                           "adj_r2": 1 - F.col("n") / (F.col("n") - 1) * (1 - r2)})
    out = out.withColumn("t", F.try_divide(F.col("coef"), F.col("std_err")))
    cols_out = ["var", F.round("coef", digits).alias("coef"), F.round("std_err", digits).alias("std_err"),
                F.round("adj_r2", digits).alias("adj_r2")]
    if with_p:
        cols_out.append(t_pvalue(F.col("t"), (F.col("n") - 1).cast("double")).alias("p_value"))
    return out.select(*cols_out)


# ------------------------------------------------------------ Fisher / ANOVA
def _class_moments(df, cols, label_col):
    long = df.select(F.col(label_col), *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([label_col], list(cols), "var", "x")
    per = long.groupBy("var", label_col).agg(F.count("x").alias("nc"), F.avg("x").alias("mc"),
                                             F.var_samp("x").alias("vc"))
    allm = long.groupBy("var").agg(F.avg("x").alias("mu"), F.count("x").alias("n"),
                                   F.countDistinct(label_col).alias("k"))
    return per.join(allm, "var")


def rank_fisher(df: DataFrame, cols, label_col: str, digits: int = 6) -> DataFrame:
    """sum_c n_c (mean_c - mean)^2 / sum_c n_c var_c (ddof 1), per feature."""
    j = _class_moments(df, cols, label_col)
    g = j.groupBy("var").agg(
        F.sum(F.col("nc") * F.pow(F.col("mc") - F.col("mu"), 2)).alias("num"),
        F.sum(F.col("nc") * F.col("vc")).alias("den"))
    return g.select("var", F.round(F.try_divide("num", "den"), digits).alias("fisher"))


def rank_anova_f(df: DataFrame, cols, label_col: str, digits: int = 6,
                 with_p: bool = False) -> DataFrame:
    """One-way ANOVA F of each feature across label classes."""
    j = _class_moments(df, cols, label_col)
    g = j.groupBy("var").agg(
        F.sum(F.col("nc") * F.pow(F.col("mc") - F.col("mu"), 2)).alias("ssb"),
        F.sum((F.col("nc") - 1) * F.coalesce(F.col("vc"), F.lit(0.0))).alias("ssw"),
        F.first("n").alias("n"), F.first("k").alias("k"))
    # null with one class or as many classes as rows
    f = F.try_divide(F.try_divide(F.col("ssb"), F.col("k") - 1), F.try_divide(F.col("ssw"), F.col("n") - F.col("k")))
    out = g.withColumn("f", f)
    cols_out = ["var", F.round("f", digits).alias("f")]
    if with_p:
        cols_out.append(f_pvalue(F.col("f"), (F.col("k") - 1).cast("double"),
                                 (F.col("n") - F.col("k")).cast("double")).alias("p_value"))
    return out.select(*cols_out)


# ------------------------------------------------------- information gain
def _h(p):
    """Binary entropy in bits; 0 for a pure group."""
    q = 1 - p
    return F.when((p <= 0) | (p >= 1), F.lit(0.0)).otherwise(-p * F.log2(p) - q * F.log2(q))


def info_gain_table(df: DataFrame, cols, label_col: str) -> DataFrame:
    """(var, value, gain) for every split ``x <= value`` of every feature but
    at each feature's largest value.  Rows are grouped to distinct values
    first; left-side counts are a range-partitioned running sum per feature."""
    long = df.select(F.col(label_col), *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([label_col], list(cols), "var", "value")
    g = long.groupBy("var", "value").agg(F.count(F.lit(1)).alias("cnt"),
                                         F.count_if(F.col(label_col) == 1).alias("pos"))
    cum = running_sums(g, "value", ["cnt", "pos"], group_cols=["var"])
    tot = g.groupBy("var").agg(F.sum("cnt").alias("N"), F.sum("pos").alias("P"),
                               F.max("value").alias("vmax"))
    j = cum.join(F.broadcast(tot), "var")  # one row per feature
    nl, pl = F.col("cnt_cum"), F.col("pos_cum")
    nr, pr = F.col("N") - nl, F.col("P") - pl
    n = F.col("N")
    gain = _h(F.col("P") / n) - (nr / n * _h(F.try_divide(pr, nr)) + nl / n * _h(pl / nl))
    return j.where(F.col("value") < F.col("vmax")).select("var", "value", gain.alias("gain"))


def info_gain_splits(df: DataFrame, c: str, label_col: str, digits: int = 6) -> DataFrame:
    return info_gain_table(df, [c], label_col).select(
        "value", F.round("gain", digits).alias("gain"))


def rank_info_gain(df: DataFrame, cols, label_col: str, digits: int = 6) -> DataFrame:
    """Best split per feature (largest gain, smallest value on ties)."""
    t = info_gain_table(df, cols, label_col)
    best = t.groupBy("var").agg(F.max_by("value", F.struct(F.col("gain"), -F.col("value")))
                                .alias("best_value"), F.max("gain").alias("gain"))
    return best.select("var", "best_value", F.round("gain", digits).alias("gain"))


# ---------------------------------------------------------- vote of selectors
def top_n(ranking: DataFrame, score_col: str, n: int, selector: str) -> DataFrame:
    """Top ``n`` features of one ranking (ties by name), tagged with the selector."""
    w = Window.orderBy(F.col(score_col).desc_nulls_last(), F.col("var"))
    return (ranking.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n)
            .select(F.lit(selector).alias("selector"), "var"))


def select_by_votes(chosen: DataFrame, n_selectors: int, threshold: float) -> DataFrame:
    """Features picked by more than ``threshold`` of the selectors."""
    return (chosen.groupBy("var").agg(F.count(F.lit(1)).alias("n_votes"))
            .withColumn("share", F.round(F.col("n_votes") / F.lit(float(n_selectors)), 6))
            .where(F.col("share") > threshold))


def select_uncorrelated(relevance: DataFrame, corr_long: DataFrame, limit: float = 0.8) -> DataFrame:
    """Walk features from most to least relevant; keep one unless it correlates
    above ``limit`` with a feature already kept.  The walk runs on the d x d
    result of one aggregation (d = number of features)."""
    order = [r["var"] for r in relevance.orderBy(F.col("abs_corr").desc_nulls_last(), "var").collect()]
    corr = {}
    for r in corr_long.collect():
        corr[(r["var1"], r["var2"])] = corr[(r["var2"], r["var1"])] = r["abs_corr"]
    kept = []
    for v in order:
        if all((corr.get((v, k)) or 0.0) <= limit for k in kept):
            kept.append(v)
    spark = relevance.sparkSession
    return spark.createDataFrame([(v, i + 1) for i, v in enumerate(kept)], "var string, rank int")


# ------------------------------------------------------------- wrappers (R)
def rank_tree_importance(df: DataFrame, cols, label_col: str, n: int | None = None,
                         seed: int = 0, max_depth: int = 18, min_split: int = 15,
                         num_trees: int = 100) -> DataFrame:
    """Importances of an extremely randomised forest: at each node the square root of the features is
    drawn, with one random cut each, and the best of those cuts is taken. Rows with a null label or
    a null or NaN feature are left out; ties go to the name."""
    from prepforge.operators.tuning import extra_specs
    from prepforge.plans import shared as SH
    from prepforge.plans import trees as TR
    cols = list(cols)
    rows = SH.training_rows(df, cols, label_col)
    codes = TR.binned(rows, TR.bin_edges(rows, len(cols)))
    grown = TR.grow(codes, extra_specs(num_trees, len(cols), "gini", min_split, 1, max_depth, seed), len(cols))
    imp = sum(t.importance(len(cols)) for t in grown) / num_trees
    out = sorted(zip(cols, imp.tolist()), key=lambda t: (-t[1], t[0]))[:n]
    return df.sparkSession.createDataFrame([(c, float(v), i + 1) for i, (c, v) in enumerate(out)], "var string, importance double, rank int")


def select_rfe(df: DataFrame, cols, label_col: str, n: int, max_iter: int = 100) -> DataFrame:
    """Recursive elimination: refit a logistic regression and drop the feature
    with the smallest |coefficient| until ``n`` remain (one fit per step)."""
    keep = list(cols)
    base = df.select(*cols, F.col(label_col).cast("double").alias("label")).persist()
    try:
        while len(keep) > n:
            data = VectorAssembler(inputCols=keep, outputCol="features").transform(base)
            coef = LogisticRegression(maxIter=max_iter).fit(data).coefficients.toArray()
            drop = min(range(len(keep)), key=lambda i: (abs(coef[i]), keep[i]))
            keep.pop(drop)
    finally:
        base.unpersist()
    return df.sparkSession.createDataFrame([(c,) for c in keep], "var string")


def select_forward_tree(df: DataFrame, cols, label_col: str, n_select: int, folds: int = 10,
                        seed: int = 0, max_depth: int = 5, id_col: str = "id") -> DataFrame:
    """Greedy forward selection by mean k-fold accuracy of a decision tree; ties go to the first column.

    Folds are stratified on the label by the key. In each step the trees of all candidates and folds
    grow together, one pass over binned rows a level, and one more pass counts their hits."""
    from prepforge.operators.tuning import folded
    from prepforge.plans import shared as SH
    from prepforge.plans import trees as TR
    cols = list(cols)
    rows = folded(df, cols, label_col, folds, seed, id_col)
    codes = TR.binned(rows, TR.bin_edges(rows, len(cols)))
    chosen, accuracy = [], []
    while len(chosen) < min(n_select, len(cols)):
        cands = [j for j in range(len(cols)) if j not in chosen]
        specs = [TR.TreeSpec("gini", max_depth, held=f, features=(*chosen, j)) for j in cands for f in range(folds)]
        counts = TR.score_trees(codes, [[t] for t in TR.grow(codes, specs, len(cols))], [s.held for s in specs], len(cols))
        tn, fp, fn, tp = np.moveaxis(SH.confusions(counts), -1, 0)
        hit = np.divide(tn + tp, tn + fp + fn + tp, out=np.zeros_like(tn), where=tn + fp + fn + tp > 0).reshape(len(cands), folds).mean(axis=1)
        best = int(hit.argmax())
        chosen.append(cands[best])
        accuracy.append(float(hit[best]))
    return df.sparkSession.createDataFrame([(cols[j], i + 1, a) for i, (j, a) in enumerate(zip(chosen, accuracy))],
                                           "var string, step int, accuracy double")


def select_genetic(df: DataFrame, cols, label_col: str, n_pop: int = 50, n_gen: int = 4,
                   folds: int = 5, seed: int = 0, cx_prob: float = 0.5, mut_prob: float = 0.2,
                   flip_prob: float = 0.1, tournament: int = 3, id_col: str = "id") -> DataFrame:
    """Genetic search over 0/1 feature masks.  Fitness is the F1 of the out-of-fold predictions of a
    logistic regression, folds stratified on the label by the key. All new masks of a generation
    and their folds are fitted by the same passes over the rows; the driver holds masks, weights and counts."""
    from prepforge.operators.tuning import folded
    from prepforge.plans import shared as SH
    rng = np.random.default_rng(seed)
    cols = list(cols)
    d = len(cols)
    rows = folded(df, cols, label_col, folds, seed, id_col)
    memo: dict[tuple, float] = {(0,) * d: -1.0}  # no columns: worse than any

    def score_all(pop):
        new = [m for m in dict.fromkeys(tuple(int(b) for b in p) for p in pop) if m not in memo]
        if new:
            specs = [SH.Logistic(1.0, "l2", 100, held=f, mask=m) for m in new for f in range(folds)]
            counts = SH.score_logistic(rows, specs, SH.fit_logistic(rows, specs, d, tol=1e-9))
            # out-of-fold predictions of all folds together
            memo.update(zip(new, SH.f1(counts.reshape(len(new), folds, *counts.shape[1:]).sum(axis=1)).tolist()))
        return [memo[tuple(int(b) for b in p)] for p in pop]

    pop = [rng.integers(0, 2, d) for _ in range(n_pop)]
    for _ in range(n_gen):
        fits = score_all(pop)
        nxt = []
        while len(nxt) < n_pop:
            a = max(rng.choice(n_pop, min(tournament, n_pop), replace=False), key=lambda i: fits[i])
            b = max(rng.choice(n_pop, min(tournament, n_pop), replace=False), key=lambda i: fits[i])
            x, y = pop[a].copy(), pop[b].copy()
            if rng.random() < cx_prob and d > 2:
                i, j = sorted(rng.choice(np.arange(1, d), 2, replace=False))
                x[i:j], y[i:j] = y[i:j].copy(), x[i:j].copy()
            for z in (x, y):
                if rng.random() < mut_prob:
                    flips = rng.random(d) < flip_prob
                    z[flips] = 1 - z[flips]
            nxt += [x, y]
        pop = nxt[:n_pop]
    score_all(pop)
    # the fittest mask of all generations; ties go to fewer columns, then to the earlier ones
    best = max(memo, key=lambda m: (memo[m], -sum(m), m))
    return df.sparkSession.createDataFrame([(c, float(memo[best])) for c, b in zip(cols, best) if b], "var string, fitness double")
