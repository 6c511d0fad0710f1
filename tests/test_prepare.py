"""Preparation steps are fitted on training rows alone; classifiers learn a planted signal."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from prepforge import catalog as CAT
from prepforge.operators import evaluate as EV
from prepforge.operators import models as M
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def prepared(spark):
    df = CAT.prepare_raw(spark, SF_SMALL)
    train = df.where("id % 5 <> 0")
    return train, df.where("id % 5 = 0"), CAT.run_preparation(2).fit(train)


def test_step_names_are_those_of_the_recorded_run(prepared):
    assert prepared[2].report == {
        "preprocessing": ["_drop_missing_values", "_boxplot_outlier_detection", "_normalize"],
        "feature_engineering": ["_extract_business_features", "SMOTE_NC_sampling"]}


def test_no_held_out_row_moves_a_bound(prepared):
    train, held, p = prepared
    known = train.na.drop()
    lo, hi = known.agg(F.min("recency"), F.max("recency")).first()
    wild = held.withColumn("recency", F.col("recency") + 10000)
    out = p.transform(wild).select("id", "recency").join(wild.na.drop().select("id", F.col("recency").alias("raw")), "id").collect()
    top = p.train.agg(F.max("recency")).first()[0]
    assert out and top <= 1.0 and all(r["recency"] > 1 for r in out)
    scaled = {round((r["raw"] - r["recency"] * 0) / 1, 6): r["recency"] for r in out}
    (a, sa), (b, sb) = sorted(scaled.items())[0], sorted(scaled.items())[-1]
    assert (b - a) / (sb - sa) <= hi - lo + 1e-6  # bounds after the outlier step lie inside all training rows'
    labels = {r[0]: r[1] for r in p.train.groupBy("response").count().collect()}
    assert labels[0] == labels[1]
    assert set(p.train.columns) >= set(CAT.FEATURED_NUMERIC) | set(CAT.C360_FLAGS)


@pytest.mark.parametrize("make", [
    lambda: M.logistic(1e4, "l2", 1600), lambda: M.logistic(1.0, "l1", 1600), lambda: M.decision_tree("entropy", 5, 10),
    lambda: M.random_trees(30, 5), lambda: M.gbt(2, 0.1, 20), lambda: M.mlp(8, (10,), 100), lambda: M.complement_nb(1.0)],
    ids=["l2", "l1", "tree", "forest", "boosted", "network", "bayes"])
def test_classifiers_find_a_planted_signal(spark, make):
    r = np.random.default_rng(7)
    x = r.random((2000, 8))
    y = (r.random(2000) < 1 / (1 + np.exp(-(9 * x[:, 0] - 9 * x[:, 1])))).astype(int)
    df = spark.createDataFrame([(i, *map(float, row), int(v)) for i, (row, v) in enumerate(zip(x, y))],
                               "id long, " + ", ".join(f"x{i} double" for i in range(1, 9)) + ", y int")
    data = M.assemble(df, [f"x{i}" for i in range(1, 9)], "y", keep=["id"])
    model = make().fit(data.where("id < 1600"))
    scored = model.transform(data.where("id >= 1600")).select("label", M.positive_prob().alias("s"))
    assert EV.auroc(scored, "label", "s").first()["auroc"] > 0.8


def test_adaboost_finds_a_planted_signal(spark):
    r = np.random.default_rng(8)
    x = r.random((600, 4))
    y = (x[:, 0] + x[:, 1] > 1).astype(int)
    df = spark.createDataFrame([(i, *map(float, row), int(v)) for i, (row, v) in enumerate(zip(x, y))],
                               "id long, x1 double, x2 double, x3 double, x4 double, y int")
    data = M.assemble(df, ["x1", "x2", "x3", "x4"], "y", keep=["id"])
    out = M.fit_adaboost(data.where("id < 400"), rounds=8).transform(data.where("id >= 400"), keep=["label"])
    assert EV.auroc(out, "label", "score").first()["auroc"] > 0.8


def test_predict_new_splits_once(spark, monkeypatch):
    """The preparation's many scans read the split's rows, they don't rank them again."""
    from prepforge import catalog as K

    class Seen(Exception):
        pass

    class Spy:
        def fit(self, train):
            raise Seen(train._jdf.queryExecution().optimizedPlan().toString())
    raw = spark.range(60).select("id", (F.col("id") % 3 == 0).cast("int").alias(K.LABEL))
    monkeypatch.setattr(K, "prepare_raw", lambda *a: raw)
    monkeypatch.setattr(K, "run_preparation", lambda seed: Spy())
    with pytest.raises(Seen) as plan:
        K.QUERIES["predict_new"](spark, "unused")
    assert "Window" not in str(plan.value) and "Join" not in str(plan.value)
