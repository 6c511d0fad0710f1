"""Second-order boosting: equal to a one-by-one brute force, and better than its base on planted rows."""
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from prepforge.operators import evaluate as EV
from prepforge.operators import tuning as TU
from prepforge.plans import boost as BO
from prepforge.plans import shared as SH
from prepforge.plans import trees as TR

D = 4
COLS = [f"x{i}" for i in range(D)]


@pytest.fixture(scope="module")
def planted(spark):
    """The label is on where x0 and x2 lie on different sides of their middle: no single column tells it."""
    r = np.random.default_rng(5)
    x = r.random((1200, D))
    p = np.where((x[:, 0] > 0.5) != (x[:, 2] > 0.5), 0.95, 0.05)
    d = pd.DataFrame(x, columns=COLS)
    d["y"], d["id"] = (r.random(1200) < p).astype(int), range(1200)
    return spark.createDataFrame(d)


@pytest.fixture(scope="module")
def rows(planted):
    return TU.folded(planted, COLS, "y", 3, 1)


@pytest.fixture(scope="module")
def codes(rows):
    edges = TR.bin_edges(rows, D)
    return TR.binned(rows, edges), edges


def slow_margins(x, y, s):
    """Margins of the rows after all rounds, one tree and node at a time."""
    z = np.zeros(len(y))
    for _ in range(s.rounds):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, p * (1 - p)
        step = np.zeros(len(y))

        def grow(on, depth):
            part = lambda m: g[m].sum() ** 2 / (h[m].sum() + s.lam)
            best = (1e-6, None)
            for f in range(x.shape[1]) if depth < s.max_depth else ():
                for c in range(TR.BINS - 1):
                    a, b = on & (x[:, f] <= c), on & (x[:, f] > c)
                    if min(h[a].sum(), h[b].sum()) < s.min_child:
                        continue
                    gain = (part(a) + part(b) - part(on)) / 2 - s.gamma
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, (a, b))
            if best[1] is None:
                step[on] = -s.rate * g[on].sum() / (h[on].sum() + s.lam)
            else:
                for m in best[1]:
                    grow(m, depth + 1)
        grow(np.ones(len(y), bool), 0)
        z = z + step
    return z


def test_boosters_equal_brute_force(codes, monkeypatch):
    data, _ = codes
    monkeypatch.setattr(BO, "REPLAY", 3)  # margins are written on the way
    specs = [BO.BoostSpec(0.3, 2, 7), BO.BoostSpec(1.0, 3, 4, held=1), BO.BoostSpec(0.5, 3, 5, lam=5.0, gamma=2.0, min_child=8.0, only=(0, 2)),
             BO.BoostSpec(rounds=0)]
    found = BO.boost(data, specs, D)
    assert [len(t) for t in found] == [7, 4, 5, 0]
    pdf = data.toPandas()
    x, y, fold = np.array([list(c) for c in pdf["codes"]]).astype(np.uint8), pdf["y"].to_numpy(), pdf["fold"].to_numpy()
    for s, trees, on in zip(specs, found, (fold >= 0, fold != 1, fold < 2)):
        assert np.allclose(BO.margins(x[on], trees, s), slow_margins(x[on], y[on], s), atol=1e-7), s


def test_fewer_rounds_are_the_first_trees(codes):
    data, _ = codes
    long, short = BO.boost(data, [BO.BoostSpec(0.5, 3, 6), BO.BoostSpec(0.5, 3, 2)], D)
    assert long[:2] == short
    share = BO.importance(long, D)
    assert np.isclose(share.sum(), 1) and share[0] + share[2] > 0.8


def test_grid_has_all_settings_and_beats_the_base(rows):
    grid = TU.settings({"learning_rate": [0.1, 0.5, 1.0], "max_depth": [3, 5], "n_estimators": [3, 6]})
    found, spec, trees, edges = TU.tune_boosted(rows, D, grid, k=3)
    assert len(found) == 12 and len({str(g) for g, _ in found}) == 12
    assert [r for _, r in found] == sorted((r for _, r in found), reverse=True)
    assert (spec.rate, spec.max_depth, len(trees)) == tuple(found[0][0][c] for c in ("learning_rate", "max_depth", "n_estimators"))
    alone = TU.tune_boosted(rows, D, [found[-1][0]], k=3)[0]
    assert np.isclose(alone[0][1], found[-1][1])
    assert len(TU.settings(TU.BOOSTED_GRID)) == 12


def test_scores_of_unseen_rows_beat_a_linear_model_and_one_stump(rows):
    learn, new = rows.where("fold < 2"), rows.where("fold = 2")
    edges = TR.bin_edges(learn, D)
    data = TR.binned(learn, edges)
    spec = BO.BoostSpec(0.3, 3, 15)
    trees, = BO.boost(data, [spec], D)
    roc = lambda df: EV.auroc(df, "y", "score").first()["auroc"]
    own = roc(BO.boosted_scores(new, spec, trees, edges, ["y"]))
    line = roc(SH.logistic_scores(new, SH.fit_logistic(learn, [SH.Logistic(1.0)], D)[0], ["y"]))
    stump = roc(TR.forest_scores(new, TR.grow(data, [TR.TreeSpec(max_depth=1)], D), edges, ["y"]))
    assert own > 0.85 > max(line, stump) + 0.1


def test_edges_of_the_input(spark, rows, codes):
    data, edges = codes
    assert BO.boost(data.where("fold > 90"), [BO.BoostSpec()], D) == [[]]  # no rows
    one = BO.boost(data.where("y = 1"), [BO.BoostSpec(1.0, 3, 50)], D)[0]  # one class: leaves only, rising
    assert all(len(t.feature) == 1 for t in one) and BO.leaf_values(one[0], BO.BoostSpec(1.0))[0] > 0
    flat = TR.binned(rows.withColumn("x", F.array(*[F.lit(1.0)] * D)), [np.array([])] * D)  # no column can be cut
    bare, = BO.boost(flat, [BO.BoostSpec(1.0, 3, 400)], D)
    assert all(len(t.feature) == 1 for t in bare) and len(bare) < 400  # settles before its rounds
    share = rows.agg(F.avg("y")).first()[0]
    assert np.isclose(BO.sigmoid(BO.margins(np.zeros((1, D), np.uint8), bare, BO.BoostSpec(1.0)))[0], share, atol=1e-4)


def test_margins_of_past_rounds_are_removed(spark, codes, monkeypatch):
    import urllib.parse
    data, edges = codes
    monkeypatch.setattr(BO, "REPLAY", 1)
    kept = []
    monkeypatch.setattr(BO, "remove_written", lambda df, f=BO.remove_written: (kept.append(df.inputFiles()[0]), f(df)))
    BO.boost(data, [BO.BoostSpec(0.5, 1, 3)], D)
    folders = {os.path.dirname(urllib.parse.urlparse(p).path) for p in kept}
    assert len(folders) == 3 and not any(os.path.exists(p) for p in folders)
    assert data.count() == 1200  # the rows themselves stay
