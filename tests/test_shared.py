"""Shared-scan fitting: the same answers as one-by-one fits, and searches that find planted columns."""
import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from prepforge.operators import evaluate as EV
from prepforge.operators import models as M
from prepforge.operators import select as SEL
from prepforge.operators import tuning as TU
from prepforge.plans import shared as SH
from prepforge.plans import trees as TR

D = 6
COLS = [f"x{i}" for i in range(D)]


@pytest.fixture(scope="module")
def planted(spark):
    """The label follows x1 - x3; a row without a label and rows without a feature are left out."""
    r = np.random.default_rng(0)
    x = r.random((1500, D))
    y = (r.random(1500) < 1 / (1 + np.exp(-(7 * x[:, 1] - 7 * x[:, 3])))).astype(int)
    d = pd.DataFrame(x, columns=COLS)
    d["y"], d["id"] = y, range(1500)
    odd = spark.createDataFrame([(*[0.5] * D, None, 9000), (*[0.5] * (D - 1), None, 1, 9001), (*[0.5] * (D - 1), float("nan"), 0, 9002)],
                                ", ".join(f"{c} double" for c in COLS) + ", y long, id long")
    return spark.createDataFrame(d).unionByName(odd)


@pytest.fixture(scope="module")
def rows(planted):
    return TU.folded(planted, COLS, "y", 5, 1)


def test_rows_without_label_or_feature_are_left_out_and_folds_are_balanced(rows):
    assert rows.count() == 1500
    n = {(r["fold"], r["y"]): r["count"] for r in rows.groupBy("fold", "y").count().collect()}
    for y in (0, 1):
        own = [v for (_, k), v in n.items() if k == y]
        assert len(own) == 5 and max(own) - min(own) <= 1


def test_logistic_equals_one_by_one_fits(planted, rows):
    specs = [SH.Logistic(c, p, held=f) for p in ("l1", "l2") for c in (1e-3, 0.1, 1.0, 1e4) for f in (None, 2)]
    w = SH.fit_logistic(rows, specs, D)
    from pyspark.ml.functions import array_to_vector
    data = rows.select(array_to_vector("x").alias("features"), F.col("y").alias("label"), "fold")
    for s, own in zip(specs, w):
        part = data if s.held is None else data.where(F.col("fold") != s.held)
        m = LogisticRegression(regParam=1 / (s.C * part.count()), elasticNetParam=float(s.penalty == "l1"), maxIter=2000, tol=1e-13,
                               standardization=False).fit(part)
        assert np.allclose(own, [*m.coefficients.toArray(), m.intercept], atol=1e-5), s


def test_a_column_of_large_scale_does_not_hold_the_others_back(rows, monkeypatch):
    passes, sums = [0], SH._loss_sums

    def counted(*a):
        passes[0] += 1
        return sums(*a)
    monkeypatch.setattr(SH, "_loss_sums", counted)
    scale = np.array([1e6, 1, 1, 1, 1e3, 1])
    wide = rows.withColumn("x", F.zip_with("x", F.array(*[F.lit(float(v)) for v in scale]), lambda a, b: a * b))
    w, = SH.fit_logistic(wide, [SH.Logistic(1e4)], D)
    assert passes[0] < 20
    assert np.allclose(w[:-1] * scale, SH.fit_logistic(rows, [SH.Logistic(1e4)], D)[0][:-1], atol=1e-2)


def test_masks_and_training_sets_of_their_own(rows):
    only = SH.fit_logistic(rows, [SH.Logistic(1.0, only=3), SH.Logistic(1.0, mask=(0, 1, 0, 1, 0, 0))], D)
    assert np.allclose(only[0], SH.fit_logistic(rows.where("fold = 3"), [SH.Logistic(1.0)], D)[0], atol=1e-7)
    assert (only[1][[0, 2, 4, 5]] == 0).all()
    narrow = rows.withColumn("x", F.array(F.col("x")[1], F.col("x")[3]))
    assert np.allclose(only[1][[1, 3, 6]], SH.fit_logistic(narrow, [SH.Logistic(1.0)], 2)[0], atol=1e-7)


def test_counts_give_the_metrics(rows):
    specs = [SH.Logistic(1.0, held=f) for f in (0, None)]
    w = SH.fit_logistic(rows, specs, D)
    counts = SH.score_logistic(rows, specs, w)
    for s, own, c in zip(specs, w, counts):
        out = SH.logistic_scores(rows if s.held is None else rows.where(F.col("fold") == s.held), own, ["y"])
        assert tuple(SH.confusions(c)) == tuple(EV.confusion(out, "y", "score", 0.5).first())
        assert np.isclose(SH.hard_profit_ratio(c), EV.profit_score(out, "y", "prediction").first()[0])


def test_all_settings_of_the_grids(spark, rows):
    found, w = TU.tune_logistic(rows, D)
    assert len(found) == 80 and w[1] > 0 > w[3]
    assert [r for _, r in found] == sorted((r for _, r in found), reverse=True)
    alone = TU.tune_logistic(rows, D, [found[3][0]])[0]
    assert np.isclose(alone[0][1], found[3][1])
    table = TU.report(spark, found)
    assert table.count() == 80 and table.select("params").distinct().count() == 80
    found, tree, edges = TU.tune_tree(rows, D)
    assert len(found) == 24 and tree.feature[0] in (1, 3)
    out = TR.forest_scores(rows, [tree], edges, keep=["id", "y"])
    assert EV.auroc(out, "y", "score").first()["auroc"] > 0.8


def slow_tree(codes, y, s, depth=0):
    """[(rows, share)] of the leaves, by brute force."""
    n = len(y)
    leaf = [(n, y.mean() if n else 0.0)]
    if depth == s.max_depth or n < max(s.min_split, 2) or y.min() == y.max():
        return leaf
    imp = lambda v: float(TR.impurity(np.array([[(v == 0).sum(), (v == 1).sum()]], float), s.criterion)[0])
    best = (1e-12, None)
    for f in s.features or range(codes.shape[1]):
        for c in range(TR.BINS - 1):
            low = codes[:, f] <= c
            if min(low.sum(), (~low).sum()) < max(s.min_leaf, 1):
                continue
            g = imp(y) - low.mean() * imp(y[low]) - (~low).mean() * imp(y[~low])
            if g > best[0] + 1e-12:
                best = (g, (f, c))
    if not best[1]:
        return leaf
    low = codes[:, best[1][0]] <= best[1][1]
    return slow_tree(codes[low], y[low], s, depth + 1) + slow_tree(codes[~low], y[~low], s, depth + 1)


def leaves(t, i=0):
    if t.feature[i] < 0:
        return [(sum(t.counts[i]), t.counts[i][1] / max(sum(t.counts[i]), 1))]
    return leaves(t, t.left[i]) + leaves(t, t.right[i])


def test_trees_equal_brute_force(rows):
    small = rows.where("fold < 2")
    edges = TR.bin_edges(small, D)
    codes = TR.binned(small, edges)
    specs = [TR.TreeSpec("gini", 3, 10), TR.TreeSpec("entropy", 3, 10, 5, held=1), TR.TreeSpec("gini", 4, 40, features=(0, 2))]
    pdf = codes.toPandas()
    raw, y, fold = np.array([list(c) for c in pdf["codes"]]), pdf["y"].to_numpy().astype(int), pdf["fold"].to_numpy()
    for s, t in zip(specs, TR.grow(codes, specs, D)):
        on = fold != s.held if s.held is not None else np.ones(len(y), bool)
        assert np.allclose(leaves(t), slow_tree(raw[on], y[on], s))
    wide, = TR.grow(codes, [TR.TreeSpec("gini", 6, 10)], D)
    narrow, = TR.grow(codes, [TR.TreeSpec("gini", 3, 50)], D)
    assert leaves(wide.pruned(3, 50)) == leaves(narrow)


def test_extremely_randomised_trees_put_planted_columns_first(planted, rows):
    out = SEL.rank_tree_importance(planted, COLS, "y", num_trees=40).collect()
    assert {r["var"] for r in out[:2]} == {"x1", "x3"} and [r["rank"] for r in out] == [1, 2, 3, 4, 5, 6]
    again = SEL.rank_tree_importance(planted.repartition(7), COLS, "y", num_trees=40).collect()
    assert [r["var"] for r in again[:2]] == [r["var"] for r in out[:2]]
    edges = TR.bin_edges(rows, D)
    trees = TR.grow(TR.binned(rows, edges), TU.extra_specs(30, D, min_split=20, held=0), D)
    assert len({(t.feature[0], t.cut[0]) for t in trees}) > 10  # cuts are drawn, not searched for
    out = TR.forest_scores(rows.where("fold = 0"), trees, edges, keep=["id", "y"])
    assert EV.auroc(out, "y", "score").first()["auroc"] > 0.8
    found, grown, _ = TU.tune_extra_trees(rows, D, n_trees=5)
    assert len(found) == 18 and len(grown) == 5


def test_forward_selection_finds_planted_columns(planted):
    out = SEL.select_forward_tree(planted, COLS, "y", 3, folds=4).collect()
    assert {r["var"] for r in out[:2]} == {"x1", "x3"} and [r["step"] for r in out] == [1, 2, 3]
    assert out[1]["accuracy"] > out[0]["accuracy"] > 0.5


def test_genetic_selection_finds_planted_columns(planted):
    out = SEL.select_genetic(planted, COLS, "y", n_pop=50, n_gen=4)
    chosen = {r["var"] for r in out.collect()}
    assert {"x1", "x3"} <= chosen and out.first()["fitness"] > 0.7


def test_networks_of_all_shapes_learn_together(rows):
    specs = [SH.Network(h, held=f) for h in ((3,), (3, 3)) for f in (0, None)]
    w = SH.fit_networks(rows, specs, D)
    counts = SH.score_networks(rows, specs, w, D)
    tn, fp, fn, tp = np.moveaxis(SH.confusions(counts), -1, 0)
    assert ((tn + tp) / (tn + tp + fn + fp) > 0.75).all()
    out = SH.network_scores(rows.where("fold = 0"), specs[0], w[0], ["id", "y"])
    assert EV.auroc(out, "y", "score").first()["auroc"] > 0.85


def test_passes_merge_their_sums(rows, monkeypatch):
    whole = SH.fit_logistic(rows, [SH.Logistic(1.0)], D)
    monkeypatch.setattr(SH, "MERGE_ABOVE", 0)
    assert np.allclose(whole, SH.fit_logistic(rows, [SH.Logistic(1.0)], D), atol=1e-9)


def test_grouped_metrics_equal_those_of_each_group(spark):
    r = np.random.default_rng(4)
    s, y, g = r.random(600).round(2), r.integers(0, 2, 600), r.integers(0, 3, 600)
    df = spark.createDataFrame([(int(a), float(b), int(c)) for a, b, c in zip(y, s, g)], "y int, s double, g int")
    for m in EV.grouped_metrics(df, ["g"]):
        own = df.where(F.col("g") == m["g"])
        best = EV.best_profit(EV.profit_curve(own, "y", "s")).first()
        rep = EV.class_report(own, "y", "s", best["best_threshold"]).first()
        assert (m["best_threshold"], m["best_profit"]) == (best["best_threshold"], best["best_profit"])
        assert np.allclose([m["auroc"], m["precision"], m["recall"], m["f1_score"], m["best_profit_ratio"]],
                           [EV.auroc(own, "y", "s").first()[0], rep["c1_precision"], rep["c1_recall"], rep["c1_f1"], best["best_profit_ratio"]])


def test_cluster_model_routes_rows_and_beats_one_model(spark):
    """In one blob the label follows x0, in the other its opposite; x1 tells the blobs apart."""
    r = np.random.default_rng(2)
    side = r.integers(0, 2, 1600)
    x = np.column_stack([r.random(1600), side * 10 + r.random(1600), r.random(1600)])
    y = (r.random(1600) < 1 / (1 + np.exp(-np.where(side, 9, -9) * (x[:, 0] - 0.5)))).astype(int)
    df = spark.createDataFrame([(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))], "id long, a double, b double, c double, y int")
    cols = ["a", "b", "c"]
    train, unseen = TU.folded(df.where("id < 1000"), cols, "y"), SH.training_rows(df.where("id >= 1000 and id < 1300"), cols, "y")
    m = M.cluster_then_model(train, unseen, 3, k_max=4, logistic=TU.settings({"penalty": ["l2"], "C": [0.01, 1.0], "max_iter": [50]}),
                             tree=TU.settings({"criterion": ["gini"], "max_depth": [1, 3], "min_samples_split": [30]}))
    assert len(m.chosen) == 2 and all(ratio > 0.3 for _, _, ratio, _ in m.chosen)
    new = SH.training_rows(df.where("id >= 1300"), cols, "y", id_col="id")
    out = m.transform(new, ["id", "y"])
    assert out.columns == ["id", "y", "cluster", "score"] and out.count() == 300
    assert {tuple(v) for v in out.selectExpr("cluster", "id").collect()} == {(int(c), i) for i, c in zip(range(1300, 1600), m.clusters(x[1300:]))}
    alone = SH.logistic_scores(new, SH.fit_logistic(train, [SH.Logistic(1.0)], 3)[0], ["y"])
    assert EV.auroc(out, "y", "score").first()["auroc"] > 0.85 > EV.auroc(alone, "y", "score").first()["auroc"] + 0.1


def test_random_search_refits_the_preparation_per_fold(spark, planted):
    from prepforge.plans import prepare as PR
    seen = []

    def preparation():
        seen.append(1)
        return PR.Preparation([PR.drop_missing()], [PR.normalize(COLS)])
    found = TU.tune_random(planted, "y", preparation, {"C": (1e-3, 1e2), "max_iter": (20, 60)}, init=6, more=4, k=3)
    assert len(seen) == 3 and len(found) == 10
    assert all(1e-3 <= g["C"] <= 1e2 and 20 <= g["max_iter"] <= 60 for g, _ in found)
    assert found[0][1] > 0.5 and [r for _, r in found] == sorted((r for _, r in found), reverse=True)


def test_tuned_cross_validation(spark, planted):
    from prepforge.operators import runner as RUN
    from prepforge.plans import prepare as PR
    grids = {"logistic": TU.settings({"penalty": ["l2"], "C": [1e-4, 10.0], "max_iter": [50]}), "network": [{"hidden": (3,)}],
             "tree": TU.settings({"criterion": ["gini"], "max_depth": [3], "min_samples_split": [30]})}
    log, steps = RUN.cv_report(planted.where("y is not null"), "y", lambda seed: PR.Preparation([PR.drop_missing()], [PR.normalize(COLS)]), seeds=(2, 3), k=3, grids=grids)
    rows = log.collect()
    assert len(rows) == 2 * 3 * 5 and {r["model_type"] for r in rows} == {"logistic", "tree", "boosted", "network", "vote"}
    assert {(r["seed"], r["fold"]) for r in rows} == {(s, f) for s in (2, 3) for f in range(3)}
    assert all(r["auroc"] > 0.7 for r in rows)
    assert {r["params"] for r in rows if r["model_type"] == "logistic"} == {"C=10, max_iter=50, penalty=l2"}
    assert steps == {"preprocessing": ["_drop_missing_values"], "feature_engineering": ["_normalize"]}
    assert RUN.averages(log).count() == 5


def test_sums_of_many_numbers_reach_the_driver_once(spark, monkeypatch):
    """Above the limit the tasks' sums are added up piece by piece in a shuffle, and one sum reaches the driver."""
    data = spark.range(0, 4000, 1, 7).selectExpr("array(double(id), 1.0D) x", "0.0D y", "int(id % 3) fold")
    step = lambda b: np.outer(SH.matrix(b.column(0)).sum(axis=0), np.arange(1500)).ravel()
    plain = SH.scan_sums(data, step, 3000)
    monkeypatch.setattr(SH, "DIRECT", 0)
    monkeypatch.setattr(SH, "PIECES", 4096)
    seen, real = [], type(data).collect

    def collect(self):
        seen.append(real(self))
        return seen[-1]
    monkeypatch.setattr(type(data), "collect", collect)
    assert (SH.scan_sums(data, step, 3000) == plain).all() and plain[1500 + 1] == 4000
    assert sum(len(r["data"]) for r in seen[-1]) == 8 * 3000  # not 7 tasks' worth


def test_a_small_table_is_spread_over_all_cores(spark):
    one = spark.range(0, 500, 1, 1).selectExpr("double(id) a", "id % 2 y")
    codes = TR.binned(SH.training_rows(one, ["a"], "y"), [np.array([100.0])])
    assert codes.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and codes.count() == 500


def test_models_of_one_fold_learn_from_it_alone(rows):
    specs = [SH.Logistic(10.0, "l2", 100, only=f) for f in (1, (2, 4))]
    w = SH.fit_logistic(rows, specs, D)
    for i, part in enumerate(("fold = 1", "fold in (2, 3)")):
        alone = SH.fit_logistic(rows.where(part), [SH.Logistic(10.0, "l2", 100)], D)
        assert np.allclose(w[i], alone[0], atol=1e-6)


def test_a_wide_level_grows_the_same_trees_in_several_passes(rows, monkeypatch):
    codes = TR.binned(rows, TR.bin_edges(rows, D))
    specs = [*TU.extra_specs(6, D, min_split=5, max_depth=6), TR.TreeSpec("gini", 4), TR.TreeSpec("entropy", 4, held=1)]
    at_once = TR.grow(codes, specs, D)
    monkeypatch.setattr(TR, "CELLS", 1)  # a tree a pass
    widths, real = [], TR.scan_sums
    monkeypatch.setattr(TR, "scan_sums", lambda data, step, size, *a, **k: widths.append(size) or real(data, step, size, *a, **k))
    some = TR.grow(codes, specs, D)
    assert [(list(t.feature), list(t.cut), list(map(tuple, t.counts))) for t in some] == \
        [(list(t.feature), list(t.cut), list(map(tuple, t.counts))) for t in at_once]
    assert len(widths) > 30


def test_absolute_penalty_reaches_the_minimum_beside_sums_of_columns():
    """Columns that are sums of others: the step is the minimum of the quadratic model, where sweeps alone stop short of it."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8))
    x = np.column_stack([x, x[:, :4].sum(axis=1), 90 * x[:, 4:].sum(axis=1), x[:, 0] + 1e-4 * rng.normal(size=400), np.ones(400)])
    k = x.shape[1]
    h = np.stack([x.T @ x + 1e-10 * np.diag(1 + (x * x).sum(axis=0))] * 3)
    g = np.stack([x.T @ rng.normal(size=400) for _ in range(3)])
    alpha, free = np.array([1e-4, 1.0, 30.0]), np.ones((3, k), bool)
    free[1, 2] = False
    g, h = np.where(free, g, 0), np.where(free[:, :, None] & free[:, None, :], h, np.eye(k))
    w = np.where(free, rng.normal(size=(3, k)), 0.0)
    u = w + SH._l1_step(w, g, h, alpha, free)
    slope = g + np.einsum("ijk,ik->ij", h, u - w)
    cost = alpha[:, None] * np.append(np.ones(k - 1), 0)
    off = np.where(u == 0, np.maximum(np.abs(slope) - cost, 0), np.abs(slope + cost * np.sign(u)))
    assert (off[free] < 1e-6).all() and u[1, 2] == 0
    assert (u[2] == 0).sum() > (u[0] == 0).sum()


def test_absolute_penalty_settles_in_few_passes_beside_sums_of_columns(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 6))
    x = np.column_stack([x, x[:, :3].sum(axis=1), 90 * x[:, 3:].sum(axis=1), x[:, 0] + 1e-4 * rng.normal(size=600)])
    y = (x[:, 0] + x[:, 3] + rng.normal(size=600) > 0).astype(float)
    data = spark.createDataFrame([(r.tolist(), float(v), -1) for r, v in zip(x, y)], "x array<double>, y double, fold int")
    passes, real = [], SH.scan_sums
    monkeypatch.setattr(SH, "scan_sums", lambda *a, **b: passes.append(1) or real(*a, **b))
    SH.fit_logistic(data, [SH.Logistic(c, "l1", 200) for c in (0.1, 10.0, 1e4)], x.shape[1])
    assert len(passes) < 20
