"""Multivariate outliers and feature extraction.

Pattern: one distributed aggregation gives the moments (means and the d x d
covariance or cross-product matrix); the small d x d algebra (inverse,
eigen-decomposition, EM or fixed-point updates) runs on the driver; the
per-row result is a column expression (a quadratic or linear form with the
fitted numbers as literals).  Isolation forests grow each tree from a
bounded hash sample inside ``applyInPandas`` and score every row with
``mapInPandas`` against the broadcast forest (n_trees x sample-size nodes).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepforge.functions.stats import column_stats, pinv, quantile
from prepforge.operators.outliers import outlier_iqr_scores
from prepforge.plans.knn import known
from prepforge.plans.prefix import written
from prepforge.plans.shared import matrix, scan_sums


# ------------------------------------------------------------------ moments
def _moment_aggs(cols) -> list:
    d = len(cols)
    x = [F.col(c).cast("double") for c in cols]
    return [F.count(F.lit(1)).alias("n")] + [F.avg(v).alias(f"m{i}") for i, v in enumerate(x)] + [
        F.covar_samp(x[i], x[j]).alias(f"c{i}_{j}") for i in range(d) for j in range(i, d)]


def _moments_of(r, d: int) -> tuple[int, np.ndarray, np.ndarray]:
    cov = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            cov[i, j] = cov[j, i] = r[f"c{i}_{j}"] or 0.0
    return int(r["n"]), np.array([r[f"m{i}"] for i in range(d)], dtype=float), cov


def moments(df: DataFrame, cols) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, mean vector, sample covariance) from one aggregation."""
    cols = list(cols)
    return _moments_of(df.agg(*_moment_aggs(cols)).first(), len(cols))


def quad_form(cols, mu, A):
    """(x - mu)' A (x - mu) as a column expression."""
    dev = [F.col(c).cast("double") - F.lit(float(m)) for c, m in zip(cols, mu)]
    d = len(cols)
    terms = []
    for i in range(d):
        for j in range(i, d):
            a = float(A[i, j] + (A[j, i] if j != i else 0.0))
            if a != 0.0:
                terms.append(F.lit(a) * dev[i] * dev[j])
    return sum(terms[1:], terms[0]) if terms else F.lit(0.0)


def lin_form(cols, mu, w):
    dev = [(F.col(c).cast("double") - F.lit(float(m))) * F.lit(float(x))
           for c, m, x in zip(cols, mu, w)]
    return sum(dev[1:], dev[0])


# -------------------------------------------------------------- Mahalanobis
def mahalanobis_scores(df: DataFrame, cols, id_col: str = "id") -> DataFrame:
    _, mu, cov = moments(df, cols)
    vi = pinv(cov)
    return df.select(id_col, F.sqrt(F.greatest(quad_form(cols, mu, vi), F.lit(0.0))).alias("md"))


def mahalanobis(df: DataFrame, cols, percent: float = 0.03, t: float = 3.0,
                id_col: str = "id") -> DataFrame:
    """Keys of the top ``int(n * percent)`` distances beyond mean +/- t*sd of the
    distances (sd with ddof 0), ranked by distance to the crossed bound."""
    md = written(mahalanobis_scores(df, cols, id_col), "md")
    st = md.agg(F.avg("md").alias("m"), F.stddev_pop("md").alias("s"), F.count(F.lit(1)).alias("n")).first()
    hi, lo = st["m"] + t * st["s"], st["m"] - t * st["s"]
    dist = F.when(F.col("md") >= hi, F.col("md") - hi).when(F.col("md") <= lo, lo - F.col("md"))
    n = int(st["n"] * percent)
    from prepforge.plans.prefix import top_n_exact
    flagged = md.withColumn("dist", dist).where(F.col("dist").isNotNull())
    return top_n_exact(flagged, "dist", [id_col], n).select(id_col)


# ------------------------------------------------------------ Cook's distance
def cooks_distance(df: DataFrame, target: str, cols, id_col: str = "id") -> DataFrame:
    """OLS of ``target`` on ``cols`` (no intercept); per row Cook's D from the
    residual and the leverage x' (X'X)^-1 x.  X'X and X'y are one aggregation."""
    cols = list(cols)
    p = len(cols)
    y = F.col(target).cast("double")
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(p):
        aggs.append(F.sum(F.col(cols[i]).cast("double") * y).alias(f"xy{i}"))
        for j in range(i, p):
            aggs.append(F.sum(F.col(cols[i]).cast("double") * F.col(cols[j]).cast("double"))
                        .alias(f"xx{i}_{j}"))
    r = df.agg(*aggs).first()
    xtx = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            xtx[i, j] = xtx[j, i] = r[f"xx{i}_{j}"]
    xty = np.array([r[f"xy{i}"] for i in range(p)])
    inv = pinv(xtx)
    beta = inv @ xty
    zero = np.zeros(p)
    fit = lin_form(cols, zero, beta)
    lev = quad_form(cols, zero, inv)
    res = df.select(id_col, (y - fit).alias("e"), lev.alias("h"))
    sse = res.agg(F.sum(F.col("e") * F.col("e"))).first()[0]
    s2 = sse / max(int(r["n"]) - p, 1)
    # null at leverage 1 or with a perfect fit
    d = F.try_divide(F.try_divide(F.pow(F.col("e"), 2), F.lit(float(p * s2))) * F.col("h"), F.pow(1 - F.col("h"), 2))
    return res.select(id_col, d.alias("cooks_d"))


def cooks_outliers(df: DataFrame, target: str, cols, id_col: str = "id") -> DataFrame:
    return outlier_iqr_scores(cooks_distance(df, target, cols, id_col), "cooks_d", id_col)


# --------------------------------------------------------- elliptic envelope
#: Random starts, how many go on to convergence after two steps each, rows that starts are drawn from, and
#: bins of the histogram that cuts each start's distances.
MCD_STARTS, MCD_KEPT, MCD_SAMPLE, MCD_BINS = 100, 10, 2000, 4096


def _root(cov: np.ndarray) -> tuple[np.ndarray, float]:
    """(W with W W' the inverse of ``cov``, its log determinant); directions without spread count as nearly flat."""
    vals, vecs = np.linalg.eigh((cov + cov.T) / 2)
    vals = np.maximum(vals, 1e-8)
    return vecs / np.sqrt(vals), float(np.log(vals).sum())


def _c_steps(rows: DataFrame, fits: list, share: float, n: int) -> list:
    """One concentration step of every (mean, covariance, log determinant) of ``fits`` side by side: a pass cuts each
    one's squared distances by a histogram at ``share`` of the rows, another takes the moments of the
    rows within the cut."""
    d = len(fits[0][0])
    at = np.triu_indices(d)
    lo, hi = -20.0, 60.0  # log2 of squared distances
    white = [(mu, _root(cov)[0]) for mu, cov, _ in fits]

    def far(x: np.ndarray, i: int) -> np.ndarray:
        mu, root = white[i]
        return (((x - mu) @ root) ** 2).sum(axis=1)

    def bins(d2: np.ndarray) -> np.ndarray:
        return np.clip(((np.log2(np.maximum(d2, 1e-300)) - lo) / (hi - lo) * MCD_BINS).astype(int), 0, MCD_BINS - 1)

    def count(b) -> np.ndarray:
        x = matrix(b.column(0))
        return np.concatenate([np.bincount(bins(far(x, i)), minlength=MCD_BINS) for i in range(len(fits))]).astype(float)

    below = np.cumsum(scan_sums(rows, count, len(fits) * MCD_BINS).reshape(len(fits), MCD_BINS), axis=1)
    cut = [int(np.searchsorted(c, share * n)) for c in below]
    size = 1 + d + len(at[0])

    def add(b) -> np.ndarray:
        x = matrix(b.column(0))
        out = np.zeros((len(fits), size))
        for i in range(len(fits)):
            own = x[bins(far(x, i)) <= cut[i]]
            out[i, 0], out[i, 1:1 + d], out[i, 1 + d:] = len(own), own.sum(axis=0), (own.T @ own)[at]
        return out.ravel()

    out = []
    for r in scan_sums(rows, add, len(fits) * size).reshape(len(fits), size):
        mu, second = r[1:1 + d] / r[0], np.zeros((d, d))
        second[at] = second[at[::-1]] = r[1 + d:]
        cov = (second - r[0] * np.outer(mu, mu)) / max(r[0] - 1, 1)
        out.append((mu, cov, _root(cov)[1]))
    return out


def fit_mcd(df: DataFrame, cols, support: float | None = None, starts: int = MCD_STARTS, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(mean, covariance) of minimum determinant over ``support`` of the rows ((n + d + 1) / 2n by default).

    ``starts`` random sets of d + 1 rows, drawn from the ``MCD_SAMPLE`` rows of least hash, and the classical
    moments take two concentration steps each, all in the same passes over the rows; the best ``MCD_KEPT`` go on until
    none lowers its determinant any more. Rows with a null or NaN are left out."""
    cols = list(cols)
    d = len(cols)
    whole = known(df, cols)
    n, mu0, cov0 = moments(whole, cols)
    sd = np.sqrt(np.where(np.diag(cov0) > 0, np.diag(cov0), 1.0))
    x = F.array(*[(F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(v)) for c, m, v in zip(cols, mu0, sd)])
    rows = written(whole.select(x.alias("x")), "mcd")
    share = support or min(1.0, (n + d + 1) / 2.0 / n)
    some = np.array([r["x"] for r in rows.orderBy(F.xxhash64("x"), "x").limit(MCD_SAMPLE).collect()], float).reshape(-1, d)
    rng = np.random.default_rng(seed)
    fits = [(np.zeros(d), cov0 / np.outer(sd, sd), 0.0)]
    for _ in range(starts):
        own = some[rng.choice(len(some), min(d + 1, len(some)), replace=False)]
        cov = np.cov(own, rowvar=False).reshape(d, d) if len(own) > 1 else np.zeros((d, d))
        fits.append((own.mean(axis=0), cov + 1e-3 * np.eye(d), 0.0))
    for _ in range(2):
        fits = _c_steps(rows, fits, share, n)
    fits = sorted(fits, key=lambda f: f[2])[:MCD_KEPT]
    best, live = [], fits
    while live:
        after = _c_steps(rows, live, share, n)
        best += [a for a, b in zip(live, after) if b[2] >= a[2] - 1e-10]
        live = [b for a, b in zip(live, after) if b[2] < a[2] - 1e-10]
    mu, cov, _ = min(best, key=lambda f: f[2])
    return mu0 + mu * sd, cov * np.outer(sd, sd)


def elliptic_envelope(df: DataFrame, cols, contamination: float = 0.1, id_col: str = "id",
                      support: float | None = None, starts: int = MCD_STARTS, seed: int = 0) -> DataFrame:
    """(id, md2, flagged): squared robust distances under :func:`fit_mcd`; the rows above their
    (1 - contamination) quantile are flagged. Rows with a null or NaN are left out."""
    cols = list(cols)
    mu, cov = fit_mcd(df, cols, support, starts, seed)
    scored = written(known(df, cols).select(id_col, quad_form(cols, mu, pinv(cov)).alias("md2")), "envelope")
    thr = quantile(scored, "md2", 1.0 - contamination)
    return scored.withColumn("flagged", F.col("md2") > F.lit(thr))


# --------------------------------------------------------------------- PCA
def _eig_desc(cov):
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = vals[order], vecs[:, order]
    for j in range(vecs.shape[1]):  # sign: largest |loading| positive
        if vecs[np.argmax(np.abs(vecs[:, j])), j] < 0:
            vecs[:, j] = -vecs[:, j]
    return np.clip(vals, 0, None), vecs


def fit_pca(train: DataFrame, cols, threshold: float = 0.8):
    """Components of the training covariance up to ``threshold`` explained variance."""
    _, mu, cov = moments(train, cols)
    vals, vecs = _eig_desc(cov)
    ratio = vals / vals.sum() if vals.sum() > 0 else vals
    k = int(np.searchsorted(np.cumsum(ratio), threshold - 1e-12) + 1)
    return mu, vecs[:, :k], ratio


def pca_project(df: DataFrame, cols, mu, comps, keep=(), prefix="c_") -> DataFrame:
    return df.select(*keep, *[lin_form(cols, mu, comps[:, j]).alias(f"{prefix}{j}")
                              for j in range(comps.shape[1])])


def explained_variance(train: DataFrame, cols) -> DataFrame:
    _, mu, cov = moments(train, cols)
    vals, _ = _eig_desc(cov)
    tot = vals.sum() or 1.0
    rows = [(j, float(v), float(v / tot * 100)) for j, v in enumerate(vals)]
    return train.sparkSession.createDataFrame(rows, "component int, variance double, pct double")


# --------------------------------------------------------------------- LDA
#: Classes whose moments reach the driver at most.
MAX_CLASSES = 1000


def fit_lda(df: DataFrame, cols, label_col: str):
    """Fisher discriminant directions: eigenvectors of Sw^-1 Sb from per-class
    moments (one grouped aggregation, at most ``MAX_CLASSES`` classes; rows with a null label are left out).  Returns
    (overall mean, directions, explained ratio); the largest loading of a direction is positive."""
    cols = list(cols)
    d = len(cols)
    rows = df.where(F.col(label_col).isNotNull()).groupBy(label_col).agg(*_moment_aggs(cols)).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label_col} has over {MAX_CLASSES} classes")
    classes = [_moments_of(r, d) for r in sorted(rows, key=lambda r: r[label_col])]
    N = sum(c[0] for c in classes)
    mu_all = sum(c[0] * c[1] for c in classes) / N
    sw = sum((c[0] - 1) * c[2] for c in classes)
    sb = sum(c[0] * np.outer(c[1] - mu_all, c[1] - mu_all) for c in classes)
    vals, vecs = np.linalg.eig(pinv(sw) @ sb)
    order = np.argsort(vals.real)[::-1]
    vals, vecs = vals.real[order], vecs.real[:, order]
    vecs = vecs * np.where(vecs[np.abs(vecs).argmax(axis=0), np.arange(vecs.shape[1])] < 0, -1.0, 1.0)
    k = max(1, min(len(classes) - 1, d))
    ratio = vals[:k] / vals[:k].sum() if vals[:k].sum() else np.ones(k) / k
    return mu_all, vecs[:, :k], ratio


# -------------------------------------------------------- factor analysis
def fit_factor_analysis(df: DataFrame, cols, n_components: int | None = None,
                        iters: int = 500, tol: float = 1e-8):
    """Gaussian factor model by EM on the covariance (one aggregation)."""
    _, mu, S = moments(df, cols)
    d = len(cols)
    k = n_components or d
    vals, vecs = _eig_desc(S)
    W = vecs[:, :k] * np.sqrt(np.maximum(vals[:k], 1e-12))
    psi = np.maximum(np.diag(S) - (W ** 2).sum(1), 1e-6)
    prev = -np.inf
    for _ in range(iters):
        C = W @ W.T + np.diag(psi)
        Ci = pinv(C)
        beta = W.T @ Ci
        Ezz = np.eye(k) - beta @ W + beta @ S @ beta.T
        W = S @ beta.T @ pinv(Ezz)
        psi = np.maximum(np.diag(S - W @ beta @ S), 1e-6)
        ll = -0.5 * (np.linalg.slogdet(C)[1] + np.trace(Ci @ S))
        if abs(ll - prev) < tol:
            break
        prev = ll
    beta = W.T @ pinv(W @ W.T + np.diag(psi))
    return mu, W, psi, beta


# ------------------------------------------------------------------ FastICA
def fit_fast_ica(df: DataFrame, cols, n_components: int | None = None, iters: int = 200,
                 tol: float = 1e-4, seed: int = 0, alpha: float = 1.0):
    """Symmetric FastICA with g = tanh.  Whitening comes from the covariance;
    each fixed-point step is one aggregation of E[g(w'z) z] and E[g'(w'z)]
    over the cached frame.  Returns (mean, unmixing matrix over x)."""
    cols = list(cols)
    _, mu, cov = moments(df, cols)
    vals, vecs = _eig_desc(cov)
    k = n_components or len(cols)
    K = (vecs[:, :k] / np.sqrt(np.maximum(vals[:k], 1e-12))).T  # k x d
    z = [lin_form(cols, mu, K[j]).alias(f"z{j}") for j in range(k)]
    data = df.select(*z).persist()
    rng = np.random.default_rng(seed)
    W = rng.normal(size=(k, k))

    def sym(Wm):
        s, u = np.linalg.eigh(Wm @ Wm.T)
        return u @ np.diag(1.0 / np.sqrt(np.maximum(s, 1e-12))) @ u.T @ Wm

    W = sym(W)
    try:
        for _ in range(iters):
            aggs = []
            for i in range(k):
                u = sum((F.lit(float(W[i, j])) * F.col(f"z{j}") for j in range(1, k)),
                        F.lit(float(W[i, 0])) * F.col("z0"))
                g = F.tanh(F.lit(alpha) * u)
                aggs += [F.avg(g * F.col(f"z{j}")).alias(f"a{i}_{j}") for j in range(k)]
                aggs.append(F.avg(F.lit(alpha) * (1 - g * g)).alias(f"b{i}"))
            r = data.agg(*aggs).first()
            W1 = np.array([[r[f"a{i}_{j}"] for j in range(k)] for i in range(k)])
            W1 = W1 - np.diag([r[f"b{i}"] for i in range(k)]) @ W
            W1 = sym(W1)
            lim = max(abs(abs(np.diag(W1 @ W.T)) - 1))
            W = W1
            if lim < tol:
                break
    finally:
        data.unpersist()
    return mu, W @ K


# ----------------------------------------------------------- multi-factor
def fit_multi_factor(df: DataFrame, groups: dict, threshold: float = 0.8):
    """Multiple factor analysis: each group's columns are standardised and
    weighted by 1 / (its first singular value), then one PCA over all
    weighted columns keeps components up to ``threshold`` of the inertia."""
    cols = [c for g in groups.values() for c in g]
    _, mu, cov = moments(df, cols)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = cov / np.outer(sd, sd)
    weights = np.ones(len(cols))
    pos = 0
    for g in groups.values():
        sl = slice(pos, pos + len(g))
        top = np.linalg.eigvalsh(corr[sl, sl]).max()
        weights[sl] = 1.0 / math.sqrt(max(top, 1e-12))
        pos += len(g)
    scale = weights / sd
    wcov = cov * np.outer(scale, scale)
    vals, vecs = _eig_desc(wcov)
    ratio = vals / vals.sum()
    k = int(np.searchsorted(np.cumsum(ratio), threshold - 1e-12) + 1)
    comps = vecs[:, :k] * scale[:, None]
    return cols, mu, comps, ratio


# ------------------------------------------------------------ isolation forests
def _c(n):
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def _grow(X, rng, depth, limit, ext, out, node=0):
    """Append nodes (node, left, right, normal..., intercept, size) to ``out``."""
    n, d = X.shape
    if depth >= limit or n <= 1 or np.all(X.max(0) == X.min(0)):
        out.append((node, -1, -1, [0.0] * d, 0.0, n))
        return node + 1
    lo, hi = X.min(0), X.max(0)
    if ext < 0:  # axis-parallel split on a feature with spread
        cand = np.where(hi > lo)[0]
        j = rng.choice(cand)
        normal = np.zeros(d)
        normal[j] = 1.0
        p = rng.uniform(lo[j], hi[j])
        icpt = p
    else:
        normal = rng.normal(size=d)
        keep = min(d, ext + 1)
        zero = rng.choice(d, d - keep, replace=False)
        normal[zero] = 0.0
        pt = rng.uniform(lo, hi)
        icpt = float(pt @ normal)
    go_left = X @ normal <= icpt
    me = len(out)
    out.append(None)
    left = node + 1
    nxt = _grow(X[go_left], rng, depth + 1, limit, ext, out, left)
    right = nxt
    nxt = _grow(X[~go_left], rng, depth + 1, limit, ext, out, right)
    out[me] = (node, left, right, normal.tolist(), icpt, n)
    return nxt


def _forest_schema(d):
    return "tree int, node int, left int, right int, normal array<double>, icpt double, size long"


def fit_isolation_forest(df: DataFrame, cols, n_trees: int = 100, sample: int = 100,
                         ext: int = -1, seed: int = 0, id_col: str = "id"):
    """Grow ``n_trees`` isolation trees, each from ``sample`` rows picked by a
    seeded hash (a Bernoulli pre-filter keeps ~4x sample rows per tree, the
    smallest hashes are kept inside the tree's group), in ``applyInPandas``.
    ``ext = -1``: axis-parallel splits; ``ext >= 0``: extended (oblique) splits
    with ext + 1 non-zero normal components.  Returns the forest as rows."""
    cols = list(cols)
    n = df.count()
    p = min(1.0, 4.0 * sample / max(n, 1))            # per-tree inclusion rate
    P = min(1.0, p * n_trees)                          # one-hash pre-filter rate
    limit = int(math.ceil(math.log2(max(sample, 2))))
    u0 = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed), F.lit(-1)), F.lit(2 ** 31))
    pre = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in cols]) \
        .where(u0 < F.lit(int(P * (2 ** 31))))         # one hash per row, ~4 x sample x trees kept
    trees = F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree")
    h = F.pmod(F.xxhash64(F.col(id_col), F.col("tree"), F.lit(seed)), F.lit(2 ** 31))
    thr = int(min(1.0, p / P) * (2 ** 31)) if P > 0 else 0
    picked = pre.select("*", trees).withColumn("__h", h).where(F.col("__h") < F.lit(thr))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(["__h", id_col]).head(sample)
        X = pdf[cols].to_numpy(dtype=float)
        rng = np.random.default_rng(seed * 100003 + t)
        out: list = []
        _grow(X, rng, 0, limit, ext, out)
        return pd.DataFrame([(t, a, b, c, list(nv), float(ic), int(sz)) for a, b, c, nv, ic, sz in out],
                            columns=["tree", "node", "left", "right", "normal", "icpt", "size"])

    forest = picked.groupBy("tree").applyInPandas(grow, _forest_schema(len(cols)))
    return forest, sample


def isolation_scores(df: DataFrame, cols, forest_rows, sample: int, id_col: str = "id") -> DataFrame:
    """Anomaly score 2^(-E[h(x)] / c(sample)) of every row; the forest (at most
    n_trees x 2 x sample nodes) is broadcast to the ``mapInPandas`` tasks."""
    cols = list(cols)
    d = len(cols)
    by_tree: dict[int, list] = {}
    for r in forest_rows:
        by_tree.setdefault(r["tree"], []).append(r)
    packed = []
    for t in sorted(by_tree):
        rows = sorted(by_tree[t], key=lambda r: r["node"])
        packed.append((np.array([r["left"] for r in rows]), np.array([r["right"] for r in rows]),
                       np.array([r["normal"] for r in rows], dtype=float).reshape(len(rows), d),
                       np.array([r["icpt"] for r in rows], dtype=float),
                       np.array([_c(r["size"]) for r in rows], dtype=float)))
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(packed)
    cn = _c(sample)

    def score(it):
        forest = bc.value
        for pdf in it:
            X = pdf[cols].to_numpy(dtype=float)
            total = np.zeros(len(pdf))
            for left, right, normal, icpt, leaf_c in forest:
                idx = np.zeros(len(pdf), dtype=int)
                depth = np.zeros(len(pdf))
                while True:
                    inner = left[idx] >= 0
                    if not inner.any():
                        break
                    rows = np.where(inner)[0]
                    nid = idx[rows]
                    go = np.einsum("ij,ij->i", X[rows], normal[nid]) <= icpt[nid]
                    idx[rows] = np.where(go, left[nid], right[nid])
                    depth[rows] += 1
                total += depth + leaf_c[idx]
            s = np.power(2.0, -(total / len(forest)) / cn) if cn else np.zeros(len(pdf))
            yield pd.DataFrame({id_col: pdf[id_col], "score": s})

    src = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in cols])
    return src.mapInPandas(score, f"{id_col} {dict(df.dtypes)[id_col]}, score double")


def isolation_forest(df: DataFrame, cols, contamination: float = 0.1, n_trees: int = 100,
                     sample: int = 100, seed: int = 0, id_col: str = "id") -> DataFrame:
    """Keys whose isolation score is above its (1 - contamination) quantile."""
    forest, s = fit_isolation_forest(df, cols, n_trees, sample, -1, seed, id_col)
    sc = written(isolation_scores(df, cols, forest.collect(), s, id_col), "isolation")
    thr = quantile(sc, "score", 1.0 - contamination)
    return sc.where(F.col("score") > F.lit(thr)).select(id_col)


def extended_isolation_forest(df: DataFrame, cols, n_trees: int = 100, sample: int = 256,
                              ext: int = 2, seed: int = 0, id_col: str = "id") -> DataFrame:
    """Oblique-split forest, then the box-plot fence on the scores (keys)."""
    forest, s = fit_isolation_forest(df, cols, n_trees, sample, ext, seed, id_col)
    sc = isolation_scores(df, cols, forest.collect(), s, id_col)
    return outlier_iqr_scores(sc, "score", id_col)


# ---------------------------------------------------------------- k-means
def kmeans_loo_gain(df: DataFrame, cols, ks, seed: int = 0, id_col: str = "id") -> DataFrame:
    """Drop in inertia when one row leaves its cluster, for each k: with the
    assignment fixed it is n_c / (n_c - 1) * |x - centre|^2 (closed form,
    one KMeans fit per k instead of one per row)."""
    data = written(VectorAssembler(inputCols=list(cols), outputCol="features").transform(df.select(id_col, *cols)), "kmeans")
    out = None
    for k in ks:
        m = KMeans(k=k, seed=seed).fit(data)
        centres = m.clusterCenters()
        pred = m.transform(data)
        c_arr = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
        x = vector_to_array(F.col("features"))
        ctr = F.element_at(c_arr, F.col("prediction") + 1)
        d2 = F.aggregate(F.zip_with(x, ctr, lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                         lambda acc, v: acc + v)
        sizes = pred.groupBy("prediction").agg(F.count(F.lit(1)).alias("nc"))
        g = pred.join(F.broadcast(sizes), "prediction").select(
            id_col, F.lit(k).alias("k"), F.col("prediction").alias("cluster"),
            F.when(F.col("nc") > 1, F.col("nc") / (F.col("nc") - 1) * d2).otherwise(F.lit(0.0))
            .alias("gain"))
        out = g if out is None else out.unionByName(g)
    return out
