"""Properties of the randomised and iterative operators (FIXTURES.md §D)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from prepforge.operators import neighbors as NB
from prepforge.operators import multivariate as MV
from prepforge.operators import sample as SA
from prepforge.operators import scale as S
from prepforge.plans.knn import knn_join


def _blobs(spark, n=400, seed=1, d=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d))
    y = (rng.random(n) < 0.15).astype(int)
    rows = [(i, *map(float, X[i]), int(y[i])) for i in range(n)]
    cols = [f"x{j}" for j in range(d)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in cols) + ", y int"), cols, X


def test_fold_sizes_balanced(spark):
    df, _, _ = _blobs(spark)
    f = SA.kfold_stratified(df, "y", 5, seed=3).groupBy("y", "fold").count().collect()
    for lab in (0, 1):
        sizes = [r["count"] for r in f if r.y == lab]
        assert max(sizes) - min(sizes) <= 1


def test_split_independent_of_partitions(spark):
    df, _, _ = _blobs(spark)
    a = {r.id: r.split for r in SA.split_stratified(df.repartition(1), "y", 0.2, 7).collect()}
    b = {r.id: r.split for r in SA.split_stratified(df.repartition(16), "y", 0.2, 7).collect()}
    assert a == b
    n_test = sum(1 for v in a.values() if v == "test")
    assert abs(n_test - 80) <= 1


def test_knn_is_exact(spark):
    df, cols, X = _blobs(spark, n=300, d=4)
    got = {(r.left_id, r.rank): r.right_id for r in knn_join(df, df, cols, 5).collect()}
    D = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(D, np.inf)
    for i in range(0, 300, 17):
        want = sorted(range(300), key=lambda j: (D[i, j], j))[:5]
        assert [got[(i, k + 1)] for k in range(5)] == want


def test_smote_balances_and_stays_in_box(spark):
    df, cols, _ = _blobs(spark)
    out = NB.smote(df, cols, "y", k=5, seed=0)
    c = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert c[0] == c[1]
    syn = out.where("synthetic").alias("s").join(
        df.select(F.col("id").alias("parent_id"), *[F.col(x).alias(f"p_{x}") for x in cols]), "parent_id")
    mino = df.where("y = 1").agg(*[F.min(x).alias(f"lo_{x}") for x in cols],
                                 *[F.max(x).alias(f"hi_{x}") for x in cols]).first()
    for r in syn.collect():
        for x in cols:
            assert mino[f"lo_{x}"] - 1e-9 <= r[x] <= mino[f"hi_{x}"] + 1e-9


def test_isolation_forest_finds_planted_outlier(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(500, 3))
    X[7] += 12
    df = spark.createDataFrame([(i, *map(float, X[i])) for i in range(500)], "id long, a double, b double, c double")
    forest, s = MV.fit_isolation_forest(df, ["a", "b", "c"], n_trees=50, sample=100)
    sc = MV.isolation_scores(df, ["a", "b", "c"], forest.collect(), s)
    top = sc.orderBy(F.col("score").desc()).first()
    assert top.id == 7


def test_yeo_johnson_near_one_for_normal(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(5, 1, 2000)], "x double")
    lam = S.fit_yeo_johnson(df, ["x"]).lambdas["x"]
    assert abs(lam - 1.0) < 0.35


def test_yeo_johnson_takes_its_grid_in_small_aggregations(spark, monkeypatch):
    """Each aggregation stays within generated code, whatever the grid, and the lambda is that of any batch."""
    df = spark.range(300).select((F.col("id") % 37).cast("double").alias("x"), (F.exp(F.col("id") / 90)).alias("y"))
    sizes, agg = [], type(df).agg

    def counted(self, *exprs):
        sizes.append(len(exprs))
        return agg(self, *exprs)
    monkeypatch.setattr(type(df), "agg", counted)
    got = S.fit_yeo_johnson(df, ["x", "y"], rounds=1)
    assert max(sizes) < 30 and len(sizes) > 4
    monkeypatch.setattr(S, "YJ_BATCH", 7)
    assert S.fit_yeo_johnson(df, ["x", "y"], rounds=1).lambdas == pytest.approx(got.lambdas)


def test_mahalanobis_ranks_planted_first(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(400, 3))
    X[11] = [6, -6, 6]
    df = spark.createDataFrame([(i, *map(float, X[i])) for i in range(400)], "id long, a double, b double, c double")
    md = MV.mahalanobis_scores(df, ["a", "b", "c"]).orderBy(F.col("md").desc()).first()
    assert md.id == 11


def test_dbscan_noise_with_hot_duplicate_group(spark):
    # a third of the rows sit on one point: they collapse to one weighted location
    rng = np.random.default_rng(9)
    X = rng.uniform(0, 1, size=(300, 2))
    X[:100] = [0.5, 0.5]
    rows = [(i, float(X[i, 0]), float(X[i, 1])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    got = sorted(r.id for r in NB.dbscan_noise(df, ["a", "b"], 0.05, 5).collect())
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    core = (D <= 0.05).sum(1) >= 5
    noise = [i for i in range(300) if not core[i] and not (core & (D[i] <= 0.05)).any()]
    assert got == noise


def test_knn_exact_with_hot_duplicates(spark):
    rng = np.random.default_rng(11)
    X = rng.normal(size=(240, 2)).round(1)
    X[:80] = [0.0, 0.0]          # a third of the rows on one point
    rows = [(i, float(X[i, 0]), float(X[i, 1])) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    got = {(r.left_id, r.rank): r.right_id for r in knn_join(df, df, ["a", "b"], 5).collect()}
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(D, np.inf)
    for i in list(range(0, 240, 7)) + [0, 1, 79, 80]:
        want = sorted(range(240), key=lambda j: (D[i, j], j))[:5]
        assert [got[(i, r + 1)] for r in range(5)] == want, i


@pytest.mark.parametrize("accuracy,bracket", [(10_000, 2_000_000), (100, 2_000_000), (100, 4)])
def test_exact_quantiles_and_top_n(spark, monkeypatch, accuracy, bracket):
    """Groups taken whole, brackets from a coarse sketch, and brackets narrowed again."""
    from prepforge.plans import prefix as P
    monkeypatch.setattr(P, "ACCURACY", accuracy)
    monkeypatch.setattr(P, "BRACKET_ROWS", bracket)
    rng = np.random.default_rng(0)
    vals = np.concatenate([rng.normal(size=2597), [3.0] * 800]).round(3)   # a hot value
    rows = [(f"k{i:05d}", float(v), int(i % 3) if i % 3 else None) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows + [("null", None, 1)], "id string, x double, g int")
    q = {r.p: r.q for r in P.exact_quantiles(df, "x", [0.0, 0.1, 0.5, 0.9, 1.0]).collect()}
    assert len(q) == 5
    for p, v in q.items():
        assert abs(v - np.percentile(vals, p * 100)) < 1e-12
    qg = {(r.g, r.p): r.q for r in P.exact_quantiles(df, "x", [0.25, 0.5], ["g"]).collect()}
    assert len(qg) == 6
    for k in (None, 1, 2):
        own = vals[np.arange(len(vals)) % 3 == (k or 0)]
        assert abs(qg[(k, 0.25)] - np.percentile(own, 25)) < 1e-12 and abs(qg[(k, 0.5)] - np.percentile(own, 50)) < 1e-12
    for n in (0, 1, 700, 1000, 3396, 3397, 3398, 5000):   # string keys break the ties
        want = [f"k{i:05d}" for i in sorted(range(len(vals)), key=lambda i: (-vals[i], i))] + ["null"]
        assert sorted(r.id for r in P.top_n_exact(df, "x", ["id"], n).collect()) == sorted(want[:n])
    assert P.exact_quantiles(df.where("id = 'null'"), "x", [0.5]).count() == 0


def test_quantiles_of_many_groups_need_no_local_table(spark, monkeypatch):
    from prepforge.plans import prefix as P
    monkeypatch.setattr(P, "MAX_LOCAL", 20)
    df = spark.range(3000).selectExpr("id", "cast(id % 100 as string) g", "cast(id * 7 % 3000 as double) x")
    pdf = df.toPandas()
    got = {(r.g, r.p): r.q for r in P.exact_quantiles(df, "x", [0.25, 0.5], ["g"]).collect()}
    assert len(got) == 200
    for g, own in pdf.groupby("g"):
        assert got[(g, 0.25)] == own.x.quantile(0.25) and got[(g, 0.5)] == own.x.quantile(0.5)


def test_running_sums_and_ranks(spark):
    from prepforge.plans.prefix import range_rank, running_sums
    rng = np.random.default_rng(3)
    v = rng.permutation(20000).astype(float)
    df = spark.createDataFrame([(float(x), 1, None if x % 2 else "a") for x in v], "x double, c int, g string")
    got = {r.x: r.c_cum for r in running_sums(df, "x", ["c"]).collect()}
    assert all(got[float(i)] == i + 1 for i in range(0, 20000, 97))
    got = {r.x: r.c_cum for r in running_sums(df, "x", ["c"], group_cols=["g"], descending=True, inclusive=False).collect()}
    assert all(got[float(i)] == (19999 - i) // 2 for i in range(0, 20000, 97))
    got = {r.x: r["rank"] for r in range_rank(df, ["x"], ["g"]).collect()}
    assert all(got[float(i)] == i // 2 for i in range(0, 20000, 97))


def test_knn_exact_with_dense_distinct_cluster(spark):
    rng = np.random.default_rng(21)
    X = rng.uniform(0, 10, size=(600, 2))
    X[:200] = 5.0 + rng.normal(scale=1e-4, size=(200, 2))   # a third: distinct but packed
    rows = [(i, float(X[i, 0]), float(X[i, 1])) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    got = {(r.left_id, r.rank): r.right_id for r in knn_join(df, df, ["a", "b"], 4).collect()}
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(D, np.inf)
    for i in list(range(0, 600, 13)) + [0, 199, 200]:
        want = sorted(range(600), key=lambda j: (D[i, j], j))[:4]
        assert [got[(i, r + 1)] for r in range(4)] == want, i


def test_dbscan_noise_with_packed_distinct_cluster(spark):
    rng = np.random.default_rng(23)
    X = rng.uniform(0, 1, size=(450, 2))
    X[:150] = 0.5 + rng.normal(scale=1e-3, size=(150, 2))    # a third, distinct but packed
    df = spark.createDataFrame([(i, float(X[i, 0]), float(X[i, 1])) for i in range(450)],
                               "id long, a double, b double")
    got = sorted(r.id for r in NB.dbscan_noise(df, ["a", "b"], 0.04, 5).collect())
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    core = (D <= 0.04).sum(1) >= 5
    noise = [i for i in range(450) if not core[i] and not (core & (D[i] <= 0.04)).any()]
    assert got == noise
