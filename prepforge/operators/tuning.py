"""Grid searches by shared scans: every setting on every fold in the same passes.

The metric is the profit ratio of hard predictions on the held-out fold, averaged over folds. Folds are
stratified on the label by a hash of the key. Each search returns every setting with its metric, best first
(ties in grid order), and the best one refitted on all rows.
"""

from __future__ import annotations

import itertools
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepforge.functions.exprs import is_numeric
from prepforge.operators import evaluate as EV
from prepforge.operators.sample import kfold_stratified
from prepforge.plans import boost as BO
from prepforge.plans import shared as SH
from prepforge.plans import trees as TR
from prepforge.plans import whole as WH
from prepforge.plans.knn import known
from prepforge.plans.prefix import written

# The reference's grids.
LOGISTIC_GRID = {"penalty": ["l1", "l2"], "C": [float(c) for c in np.logspace(-4, 4, 20)], "max_iter": [100, 200]}
TREE_GRID = {"criterion": ["entropy", "gini"], "max_depth": [3, 4, 5, 6], "min_samples_split": [30, 50, 70]}
EXTRA_GRID = {"min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 3, 6], "criterion": ["gini", "entropy"]}
NETWORK_GRID = {"hidden": [(3,), (6,), (3, 3), (5, 5)]}
BOOSTED_GRID = {"learning_rate": [0.1, 0.5, 1.0], "max_depth": [3, 5], "n_estimators": [100, 200]}
#: Extremely randomised trees have no depth limit of their own; this one is out of reach of any table
#: that halves its nodes now and then.
UNLIMITED = 64


def settings(grid: dict) -> list[dict]:
    return [dict(zip(grid, v)) for v in itertools.product(*grid.values())]


def folded(df: DataFrame, cols, label_col: str, k: int = 5, seed: int = 0, id_col: str = "id") -> DataFrame:
    """:func:`prepforge.plans.shared.training_rows` with ``k`` folds, stratified on the label by the key."""
    whole = known(df, cols).where(F.col(label_col).isNotNull())
    return SH.training_rows(kfold_stratified(whole, label_col, k, seed, id_col), cols, label_col, "fold", id_col)


def ranked(grid: list[dict], ratios: np.ndarray) -> list[tuple[dict, float]]:
    order = sorted(range(len(grid)), key=lambda i: (-ratios[i], i))
    return [(grid[i], float(ratios[i])) for i in order]


def tune_logistic(rows: DataFrame, n_features: int, grid: list[dict] | None = None, k: int = 5) -> tuple[list[tuple[dict, float]], np.ndarray]:
    """(settings with their ratio, weights of the best on all rows) of a logistic regression."""
    grid = grid or settings(LOGISTIC_GRID)
    specs = [SH.Logistic(g["C"], g["penalty"], g["max_iter"], held=f) for g in grid for f in [*range(k), None]]
    w = SH.fit_logistic(rows, specs, n_features)
    held = [i for i, s in enumerate(specs) if s.held is not None]
    ratio = SH.hard_profit_ratio(SH.score_logistic(rows, [specs[i] for i in held], w[held]))
    out = ranked(grid, ratio.reshape(len(grid), k).mean(axis=1))
    return out, w[grid.index(out[0][0]) * (k + 1) + k]

def tune_tree(rows: DataFrame, n_features: int, grid: list[dict] | None = None, k: int = 5):
    """(settings with their ratio, the best tree on all rows, bin edges) of a decision tree. One tree a
    criterion and fold is grown to the grid's widest limits; the stricter settings are cut from it."""
    grid = grid or settings(TREE_GRID)
    edges = TR.bin_edges(rows, n_features)
    codes = TR.binned(rows, edges)
    deep, least = max(g["max_depth"] for g in grid), min(g["min_samples_split"] for g in grid)
    keys = [(c, f) for c in dict.fromkeys(g["criterion"] for g in grid) for f in [*range(k), None]]
    grown = dict(zip(keys, TR.grow(codes, [TR.TreeSpec(c, deep, least, held=f) for c, f in keys], n_features)))
    cut = lambda g, f: grown[g["criterion"], f].pruned(g["max_depth"], g["min_samples_split"])
    models = [(g, f) for g in range(len(grid)) for f in range(k)]
    counts = TR.score_trees(codes, [[cut(grid[g], f)] for g, f in models], [f for _, f in models], n_features)
    out = ranked(grid, SH.hard_profit_ratio(counts).reshape(len(grid), k).mean(axis=1))
    return out, cut(out[0][0], None), edges


def tune_network(rows: DataFrame, n_features: int, grid: list[dict] | None = None, k: int = 5, max_iter: int = 100, seed: int = 0):
    """(settings with their ratio, spec and weights of the best on all rows) of a network. L-BFGS has no learning
    rate, so the grid is that of the hidden layers."""
    grid = grid or settings(NETWORK_GRID)
    specs = [SH.Network(tuple(g["hidden"]), max_iter=max_iter, held=f, seed=seed) for g in grid for f in [*range(k), None]]
    w = SH.fit_networks(rows, specs, n_features)
    held = [i for i, s in enumerate(specs) if s.held is not None]
    ratio = SH.hard_profit_ratio(SH.score_networks(rows, [specs[i] for i in held], [w[i] for i in held], n_features))
    out = ranked(grid, ratio.reshape(len(grid), k).mean(axis=1))
    best = grid.index(out[0][0]) * (k + 1) + k
    return out, specs[best], w[best]


def extra_specs(n: int, n_features: int, criterion: str = "gini", min_split: int = 2, min_leaf: int = 1, max_depth: int = UNLIMITED,
                seed: int = 0, **rows) -> list[TR.TreeSpec]:
    """``n`` extremely randomised trees that draw the square root of the features at each node."""
    draw = max(1, int(np.sqrt(n_features)))
    return [TR.TreeSpec(criterion, max_depth, min_split, min_leaf, draw=draw, seed=seed * 1_000_003 + i, **rows) for i in range(n)]


def tune_extra_trees(rows: DataFrame, n_features: int, grid: list[dict] | None = None, k: int = 5, n_trees: int = 100, seed: int = 0):
    """(settings with their ratio, the best forest on all rows, bin edges) of extremely randomised trees.
    Forests of one criterion and leaf size are grown once and, cut back, serve every split size: each inside a task where
    one can hold the coded rows (the best forest is then a written table), else all in the same passes."""
    grid = grid or settings(EXTRA_GRID)
    edges = TR.bin_edges(rows, n_features)
    codes = TR.binned(rows, edges)
    least = min(g["min_samples_split"] for g in grid)
    ratios, inside = np.zeros(len(grid)), WH.fits(codes, n_features)
    kinds = list(dict.fromkeys((g["criterion"], g["min_samples_leaf"]) for g in grid))
    of = {v: [i for i, g in enumerate(grid) if (g["criterion"], g["min_samples_leaf"]) == v] for v in kinds}
    splits = {v: [grid[i]["min_samples_split"] for i in of[v]] for v in kinds}
    if inside:
        forests = [(extra_specs(n_trees, n_features, c, least, leaf, seed=seed, held=f), f * n_trees, splits[c, leaf]) for c, leaf in kinds for f in range(k)]
        counts = WH.forest_counts(codes, forests, n_features)
        for n, v in enumerate(kinds):
            ratios[of[v]] = np.mean([SH.hard_profit_ratio(x) for x in counts[n * k:(n + 1) * k]], axis=0)
    else:
        for c, leaf in kinds:
            trees = TR.grow(codes, [s for f in range(k) for s in extra_specs(n_trees, n_features, c, least, leaf, seed=seed, held=f)], n_features)
            forests = [[t.pruned(UNLIMITED, size) for t in trees[f * n_trees:(f + 1) * n_trees]] for size in splits[c, leaf] for f in range(k)]
            own = of[c, leaf]
            counts = TR.score_trees(codes, forests, [f for _ in own for f in range(k)], n_features)
            ratios[own] = SH.hard_profit_ratio(counts).reshape(len(own), k).mean(axis=1)
    out = ranked(grid, ratios)
    g = out[0][0]
    specs = extra_specs(n_trees, n_features, g["criterion"], g["min_samples_split"], g["min_samples_leaf"], seed=seed)
    return out, (WH.forest if inside else TR.grow)(codes, specs, n_features), edges


def tune_boosted(rows: DataFrame, n_features: int, grid: list[dict] | None = None, k: int = 5):
    """(settings with their ratio, spec and trees of the best on all rows, bin edges) of second-order boosted trees. One
    booster a rate, depth and fold grows to the grid's most rounds; the settings with fewer are its first trees. Boosters
    grow inside tasks where one can hold the coded rows, else all in the same passes."""
    grid = grid or settings(BOOSTED_GRID)
    edges = TR.bin_edges(rows, n_features)
    codes = TR.binned(rows, edges)
    kinds = list(dict.fromkeys((g["learning_rate"], g["max_depth"]) for g in grid))
    rounds = {v: sorted({g["n_estimators"] for g in grid if (g["learning_rate"], g["max_depth"]) == v}) for v in kinds}
    keys = [(v, f) for v in kinds for f in [*range(k), None]]
    specs = {(v, f): BO.BoostSpec(v[0], v[1], rounds[v][-1], held=f) for v, f in keys}
    tried = [(v, f) for v, f in keys if f is not None]
    if WH.fits(codes, n_features):
        grown = dict(zip(keys, WH.boosters(codes, list(specs.values()), n_features, [rounds[v] for v, _ in keys])))
        counts = np.concatenate([x if len(x := grown[t]) else np.zeros((len(rounds[t[0]]), EV.N_THRESHOLDS + 1, 2)) for t in tried])
    else:
        grown = dict(zip(keys, BO.boost(codes, list(specs.values()), n_features)))
        counts = BO.score_boosted(codes, [(specs[x], grown[x], rounds[x[0]]) for x in tried], n_features)
    by = {}
    for (v, r), ratio in zip([(v, r) for v, _ in tried for r in rounds[v]], SH.hard_profit_ratio(counts)):
        by.setdefault((*v, r), []).append(ratio)
    out = ranked(grid, np.array([np.mean(by[g["learning_rate"], g["max_depth"], g["n_estimators"]]) for g in grid]))
    best = out[0][0]
    whole = ((best["learning_rate"], best["max_depth"]), None)
    return out, specs[whole], grown[whole][:best["n_estimators"]], edges


def tune_random(df: DataFrame, label_col: str, preparation, bounds: dict, init: int = 50, more: int = 100, seed: int = 0, k: int = 5,
                id_col: str = "id", threads: int = 4) -> list[tuple[dict, float]]:
    """Random search whose unit is the preparation and the model: ``preparation`` (a function that returns a
    :class:`prepforge.plans.prepare.Preparation`) is fitted on each fold's other rows once, all draws share the
    prepared folds, and a draw's metric is the mean profit ratio on the folds.

    ``init`` logistic regressions are drawn inside ``bounds`` ({"C": (low, high), "max_iter": (low, high)}, C on a log
    scale), then ``more`` around the best tenth of them, with a spread that is a tenth of the bounds, clipped
    to them. Every draw is returned, best first."""
    from concurrent.futures import ThreadPoolExecutor
    data = written(kfold_stratified(df.where(df[label_col].isNotNull()), label_col, k, seed, id_col), "folds")

    def prepare(f: int):
        p = preparation().fit(data.where(F.col("fold") != f).drop("fold"))
        return p.train.withColumn("fold", F.lit(f)), p.transform(data.where(F.col("fold") == f))
    with ThreadPoolExecutor(threads) as pool:
        parts = list(pool.map(prepare, range(k)))
    cols = [c for c, t in parts[0][0].dtypes if c not in (id_col, label_col, "fold", "row_key") and is_numeric(t)]
    train, test = (reduce(DataFrame.unionByName, [p[i].select(*cols, label_col, "fold") for p in parts]) for i in (0, 1))
    train, test = SH.training_rows(train, cols, label_col, "fold"), SH.training_rows(test, cols, label_col, "fold")
    rng = np.random.default_rng(seed)
    (c_low, c_high), (i_low, i_high) = np.log10(bounds["C"]), bounds["max_iter"]

    def ratios(draws: list[dict]) -> np.ndarray:
        specs = [SH.Logistic(g["C"], g["penalty"], g["max_iter"], only=f) for g in draws for f in range(k)]
        w = SH.fit_logistic(train, specs, len(cols), tol=1e-9)
        held = [SH.Logistic(held=f) for _ in draws for f in range(k)]
        return SH.hard_profit_ratio(SH.score_logistic(test, held, w)).reshape(len(draws), k).mean(axis=1)

    def draw(c: float, i: float, spread: float) -> dict:
        c, i = rng.normal(c, spread * (c_high - c_low)), rng.normal(i, spread * (i_high - i_low))
        return {"C": float(10 ** np.clip(c, c_low, c_high)), "max_iter": int(np.clip(round(i), i_low, i_high)), "penalty": "l2"}
    first = [{"C": float(10 ** rng.uniform(c_low, c_high)), "max_iter": int(rng.integers(i_low, i_high + 1)), "penalty": "l2"} for _ in range(init)]
    score = ratios(first)
    top = ranked(first, score)[:max(1, init // 10)]
    second = [draw(np.log10(g["C"]), g["max_iter"], 0.1) for g, _ in (top[int(rng.integers(len(top)))] for _ in range(more))]
    return ranked([*first, *second], np.concatenate([score, ratios(second) if second else []]))


def report(spark, found: list[tuple[dict, float]]) -> DataFrame:
    """(params, profit_ratio, rank), one row a setting."""
    return spark.createDataFrame([(", ".join(f"{k}={v:.6g}" if isinstance(v, float) else f"{k}={v}" for k, v in sorted(g.items())), r, i + 1)
                                  for i, (g, r) in enumerate(found)], "params string, profit_ratio double, rank int")
