"""Classifiers, tuning, soft voting, boosting, cluster-then-model, scoring.

All models are ``pyspark.ml`` estimators fitted on an assembled vector
column; tuning is ``CrossValidator`` with a fold column and the reference's
profit metric as a custom ``Evaluator``.  Only parameter grids, fitted
coefficients and per-fold metrics (a few numbers) reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, MultilayerPerceptronClassifier,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepforge.operators import evaluate as EV
from prepforge.plans.prefix import written

FEATURES = "features"
LABEL = "label"


def assemble(df: DataFrame, cols, label_col: str | None = None, keep=()) -> DataFrame:
    out = VectorAssembler(inputCols=list(cols), outputCol=FEATURES).transform(df)
    sel = [*keep, FEATURES]
    if label_col:
        sel.append(F.col(label_col).cast("double").alias(LABEL))
    return out.select(*sel)


def positive_prob(col: str = "probability"):
    return vector_to_array(F.col(col)).getItem(1)


# -------------------------------------------------------------- evaluator
class ProfitEvaluator(Evaluator):
    """Best profit ratio over the 40-threshold grid, from ``prediction``
    (hard 0/1 labels, as the reference scored its grid search) or from the
    positive-class probability when ``on='probability'``."""

    on = Param(Params._dummy(), "on", "prediction or probability", TypeConverters.toString)

    def __init__(self, on: str = "prediction"):
        super().__init__()
        self._setDefault(on="prediction")
        self._set(on=on)

    def _evaluate(self, dataset: DataFrame) -> float:
        on = self.getOrDefault(self.on)
        score = F.col("prediction") if on == "prediction" else positive_prob()
        df = dataset.select(F.col(LABEL).alias("y"), score.alias("s"))
        r = EV.best_profit(EV.profit_curve(df, "y", "s")).first()
        return float(r["best_profit_ratio"] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


# ---------------------------------------------------------------- models
def logistic(C: float = 1e4, penalty: str = "l2", n_rows: int = 1, max_iter: int = 100):
    """sklearn's C on a summed loss equals Spark's regParam = 1 / (C * n) on a mean loss."""
    return LogisticRegression(regParam=1.0 / (C * max(n_rows, 1)),
                              elasticNetParam=1.0 if penalty == "l1" else 0.0,
                              maxIter=max_iter, standardization=False)


def decision_tree(impurity="gini", max_depth=5, min_split=2, seed=0):
    return DecisionTreeClassifier(impurity=impurity, maxDepth=max_depth,
                                  minInstancesPerNode=max(1, min_split // 2), seed=seed)


def complement_nb(smoothing=1.0):
    """Needs non-negative inputs: give it min-max features clipped at 0 (see ``clip_features``)."""
    return NaiveBayes(modelType="complement", smoothing=smoothing)


def clip_features(df: DataFrame, lo: float = 0.0) -> DataFrame:
    """Features clipped below at ``lo`` (unseen rows can fall under a train minimum)."""
    arr = vector_to_array(F.col(FEATURES))
    return df.withColumn(FEATURES, array_to_vector(F.transform(arr, lambda x: F.greatest(x, F.lit(lo)))))


def random_trees(n=100, max_depth=5, seed=0):
    return RandomForestClassifier(numTrees=n, maxDepth=max_depth, bootstrap=False, seed=seed)


def gbt(max_depth=2, step=0.1, n=100, seed=0):
    return GBTClassifier(maxDepth=max_depth, stepSize=step, maxIter=n, seed=seed)


def mlp(n_features: int, hidden=(10,), max_iter=200, seed=0):
    """L-BFGS: plain gradient steps of the same number leave the network far from fitted."""
    return MultilayerPerceptronClassifier(layers=[n_features, *hidden, 2], solver="l-bfgs",
                                          maxIter=max_iter, seed=seed)


def linear_svc(reg=0.01, max_iter=100):
    return LinearSVC(regParam=reg, maxIter=max_iter)


# ---------------------------------------------------------------- tuning
def tune_grid(data: DataFrame, estimator, grid, fold_col: str | None = "fold",
              num_folds: int = 5, parallelism: int = 4, on: str = "prediction", seed: int = 0):
    """Grid search with k-fold CV on the profit metric; refits the best."""
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid,
                        evaluator=ProfitEvaluator(on), parallelism=parallelism, seed=seed,
                        numFolds=num_folds, **({"foldCol": fold_col} if fold_col else {}))
    return cv.fit(data)


def cv_summary(cv_model, spark) -> DataFrame:
    rows = []
    for pm, m in zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics):
        rows.append((", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda t: t[0].name)),
                     float(m)))
    return spark.createDataFrame(rows, "params string, profit_ratio double")


# ------------------------------------------------------------ ensembles
def vote_soft(models, data: DataFrame, keep=()) -> DataFrame:
    """Mean positive-class probability over fitted models and its argmax."""
    out = data
    probs = []
    for i, m in enumerate(models):
        m = m.copy()
        for c, name in (("probabilityCol", f"__p{i}"), ("predictionCol", f"__y{i}"),
                        ("rawPredictionCol", f"__r{i}")):
            if m.hasParam(c):
                m.set(m.getParam(c), name)
        out = m.transform(out)
        probs.append(vector_to_array(F.col(f"__p{i}")).getItem(1))
    mean = sum(probs[1:], probs[0]) / len(probs)
    return out.select(*keep, mean.alias("score"), (mean >= 0.5).cast("double").alias("prediction"))


def fit_adaboost(data: DataFrame, rounds: int = 50, rate: float = 1.0, seed: int = 0,
                 checkpoint_every: int = 10):
    """Discrete AdaBoost (SAMME, two classes) of depth-1 trees.  The sample
    weight is a column updated from each stump's predictions; the frame is
    checkpointed every ``checkpoint_every`` rounds to cut lineage."""
    n = data.count()
    w = data.withColumn("__w", F.lit(1.0 / n)).persist()
    stumps, alphas = [], []
    for t in range(rounds):
        stump = DecisionTreeClassifier(maxDepth=1, weightCol="__w", seed=seed + t,
                                       predictionCol="__pred", probabilityCol="__prob",
                                       rawPredictionCol="__raw").fit(w)
        scored = stump.transform(w)
        miss = (F.col("__pred") != F.col(LABEL)).cast("double")
        r = scored.agg(F.sum(F.col("__w") * miss).alias("e"), F.sum("__w").alias("s")).first()
        err = (r["e"] or 0.0) / (r["s"] or 1.0)
        if err <= 0:
            stumps.append(stump)
            alphas.append(1.0)
            break
        if err >= 0.5:
            break
        alpha = rate * math.log((1 - err) / err)
        stumps.append(stump)
        alphas.append(alpha)
        prev = w
        w = scored.withColumn("__w", F.col("__w") * F.exp(F.lit(alpha) * miss)) \
            .drop("__pred", "__prob", "__raw")
        w = w.checkpoint() if (t + 1) % checkpoint_every == 0 else w.persist()
        prev.unpersist()
    w.unpersist()
    return AdaBoostModel(stumps, alphas)


class AdaBoostModel:
    def __init__(self, stumps, alphas):
        self.stumps, self.alphas = stumps, alphas

    def transform(self, df: DataFrame, keep=()) -> DataFrame:
        out = df
        total = F.lit(0.0)
        for i, (s, a) in enumerate(zip(self.stumps, self.alphas)):
            s = s.copy({s.predictionCol: f"__p{i}", s.probabilityCol: f"__q{i}",
                        s.rawPredictionCol: f"__r{i}"})
            out = s.transform(out)
            total = total + F.lit(a) * (2 * F.col(f"__p{i}") - 1)
        norm = float(sum(abs(a) for a in self.alphas) or 1.0)
        score = (total / F.lit(norm) + 1) / 2
        return out.select(*keep, score.alias("score"), (score >= 0.5).cast("double").alias("prediction"))


# ------------------------------------------------------------ clustering
def kmeans_costs(data: DataFrame, ks, seed: int = 0) -> list[tuple[int, float]]:
    """Within-cluster sum of squares for each k (k = 1 is the total sum of squares)."""
    out = []
    for k in ks:
        if k == 1:
            st = data.select(vector_to_array(FEATURES).alias("a"))
            d = len(st.first()["a"])
            arr = st.select(*[F.col("a")[i].alias(f"x{i}") for i in range(d)])
            agg = arr.agg(*[F.var_pop(f"x{i}") for i in range(d)], F.count(F.lit(1))).first()
            out.append((1, float(sum(agg[:d]) * agg[d])))
            continue
        m = KMeans(k=k, seed=seed, featuresCol=FEATURES).fit(data)
        out.append((k, float(m.summary.trainingCost)))
    return out


def elbow_k(costs: list[tuple[int, float]]) -> int:
    """k at the largest bend: the largest drop in slope between neighbours."""
    best, best_k = -float("inf"), costs[min(1, len(costs) - 1)][0]
    for i in range(len(costs) - 2):
        (k0, c0), (k1, c1), (k2, c2) = costs[i], costs[i + 1], costs[i + 2]
        bend = (c0 - c1) / (k1 - k0) - (c1 - c2) / (k2 - k1)
        if bend > best:
            best, best_k = bend, k1
    return best_k


@dataclass
class ClusterModel:
    """k-means centres and one fitted model a cluster: (kind, settings, best profit ratio on the unseen rows,
    logistic weights or a tree), and the bin edges that the trees read."""
    centres: np.ndarray
    chosen: list[tuple]
    edges: list[np.ndarray]
    costs: list[tuple[int, float]]

    def clusters(self, x: np.ndarray) -> np.ndarray:
        return ((x[:, None, :] - self.centres[None]) ** 2).sum(axis=2).argmin(axis=1)

    def transform(self, df: DataFrame, keep=("id",)) -> DataFrame:
        """``keep``, ``cluster`` and ``score`` of rows with ``x``: each row goes to its cluster's model, in one pass."""
        from prepforge.plans import shared as SH
        from prepforge.plans import trees as TR

        def run(batches):
            for b in batches:
                x = SH.matrix(b.column(b.schema.get_field_index("x")))
                at = self.clusters(x)
                codes = np.column_stack([np.searchsorted(e, x[:, j], side="left").astype(np.uint8) for j, e in enumerate(self.edges)])
                p = np.zeros(len(x))
                for c, (kind, _, _, m) in enumerate(self.chosen):
                    rows = np.flatnonzero(at == c)
                    p[rows] = TR.leaf_scores(m)[TR.positions(codes[rows], m)] if kind == "tree" else \
                        1 / (1 + np.exp(-np.clip(x[rows] @ m[:-1] + m[-1], -500, 500)))
                yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in keep], pa.array(at.astype(np.int32)), pa.array(p)],
                                                 names=[*keep, "cluster", "score"])
        schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("cluster", T.IntegerType()), T.StructField("score", T.DoubleType())])
        return df.select(*dict.fromkeys([*keep, "x"])).mapInArrow(run, schema)


def cluster_then_model(train: DataFrame, unseen: DataFrame, n_features: int, k_max: int = 14, min_rows: int = 10, folds: int = 5,
                       seed: int = 0, costs=None, logistic=None, tree=None) -> ClusterModel:
    """Choose k by the elbow, shrink k until every cluster has ``min_rows`` training rows; then in each cluster
    tune every kind of model over the folds of its training rows and keep the kind whose best
    setting, refitted, gives the best profit ratio on the cluster's unseen rows (the first on ties).

    ``train`` and ``unseen`` are :func:`prepforge.plans.shared.training_rows`, ``train`` with folds. The settings (``logistic``,
    ``tree``; the reference's grids if None) of all clusters and folds are fitted by the same passes."""
    from prepforge.operators import tuning as TU
    from prepforge.plans import shared as SH
    from prepforge.plans import trees as TR
    vec = train.select(array_to_vector("x").alias(FEATURES))
    costs = costs or kmeans_costs(vec, range(1, k_max + 1), seed)
    k = elbow_k(costs)
    while True:
        km = KMeans(k=k, seed=seed, featuresCol=FEATURES, predictionCol="cluster").fit(vec)
        sizes = km.transform(vec).groupBy("cluster").count().collect()  # k rows
        if k == 1 or (len(sizes) == k and min(r["count"] for r in sizes) >= min_rows):
            break
        k -= 1
    model = ClusterModel(np.array(km.clusterCenters()), [], [], costs)

    def coded(df: DataFrame, code: Callable) -> DataFrame:
        """``df`` with ``fold`` replaced by a code of the row's cluster (and fold)."""
        def run(batches):
            for b in batches:
                c = model.clusters(SH.matrix(b.column(0)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(code(c, b.column(2).to_numpy()).astype(np.int32))], names=["x", "y", "fold"])
        return written(df.select("x", "y", "fold").mapInArrow(run, "x array<double>, y double, fold int"), "clusters")

    rows, new = coded(train, lambda c, f: c * folds + f), coded(unseen, lambda c, f: c)
    logistic, tree = logistic or TU.settings({**TU.LOGISTIC_GRID, "max_iter": [100]}), tree or TU.settings(TU.TREE_GRID)
    whole = lambda c: (c * folds, (c + 1) * folds)
    cells = [(c, f) for c in range(k) for f in [*range(folds), None]]
    held = lambda c, f: None if f is None else c * folds + f
    # logistic regressions
    specs = [SH.Logistic(g["C"], g["penalty"], g["max_iter"], held(c, f), whole(c)) for g in logistic for c, f in cells]
    w = SH.fit_logistic(rows, specs, n_features, tol=1e-9)
    scored = [i for i, s in enumerate(specs) if s.held is not None]
    ratio = SH.hard_profit_ratio(SH.score_logistic(rows, [specs[i] for i in scored], w[scored])).reshape(len(logistic), k, folds).mean(axis=2)
    best_l = ratio.argmax(axis=0)
    w = w.reshape(len(logistic), k, folds + 1, -1)[best_l, np.arange(k), folds]
    # trees
    model.edges = TR.bin_edges(rows, n_features)
    codes, new_codes = TR.binned(rows, model.edges), TR.binned(new, model.edges)
    deep, least = max(g["max_depth"] for g in tree), min(g["min_samples_split"] for g in tree)
    kinds = list(dict.fromkeys(g["criterion"] for g in tree))
    keys = [(v, c, f) for v in kinds for c, f in cells]
    grown = dict(zip(keys, TR.grow(codes, [TR.TreeSpec(v, deep, least, held=held(c, f), only=whole(c)) for v, c, f in keys], n_features)))
    cut = lambda g, c, f: grown[g["criterion"], c, f].pruned(g["max_depth"], g["min_samples_split"])
    tried = [(g, c, f) for g in tree for c in range(k) for f in range(folds)]
    ratio = SH.hard_profit_ratio(TR.score_trees(codes, [[cut(*t)] for t in tried], [held(c, f) for _, c, f in tried], n_features))
    best_t = ratio.reshape(len(tree), k, folds).mean(axis=2).argmax(axis=0)
    own = [cut(tree[best_t[c]], c, None) for c in range(k)]
    # the kinds against each other, on the unseen rows of each cluster
    by_l = SH.best_profit_ratio(SH.score_logistic(new, [SH.Logistic(held=c) for c in range(k)], w))
    by_t = SH.best_profit_ratio(TR.score_trees(new_codes, [[t] for t in own], list(range(k)), n_features))
    for c in range(k):
        model.chosen.append(("logistic", logistic[best_l[c]], float(by_l[c]), w[c]) if by_l[c] >= by_t[c] else
                            ("tree", tree[best_t[c]], float(by_t[c]), own[c]))
    return model


# ------------------------------------------------------------- final scoring
# Fixed values of the reference's final model.
FINAL_C = 0.5571
FINAL_MAX_ITER = 200


def fit_final(train: DataFrame, cols, label_col: str, n_rows: int | None = None) -> PipelineModel:
    n = n_rows or train.count()
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol=FEATURES),
                            logistic(FINAL_C, "l2", n, FINAL_MAX_ITER).setLabelCol(LABEL)])
    return pipe.fit(train.withColumn(LABEL, F.col(label_col).cast("double")))


def coef_rank(model, cols, spark) -> DataFrame:
    coef = model.coefficients.toArray()
    rows = sorted(zip(cols, coef.tolist()), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame([(c, float(v), i + 1) for i, (c, v) in enumerate(rows)],
                                 "var string, coef double, rank int")

