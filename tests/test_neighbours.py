"""The pivot index over many columns, and the operators that resample and judge by neighbours."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from prepforge.operators import neighbors as NB
from prepforge.plans import knn as K


def frame(spark, x, **more):
    d = pd.DataFrame(x, columns=[f"x{i}" for i in range(x.shape[1])])
    d.insert(0, "id", range(len(x)))
    for k, v in more.items():
        d[k] = v
    return spark.createDataFrame(d), [f"x{i}" for i in range(x.shape[1])]


def clusters(n, d, size=50, seed=0):
    r = np.random.default_rng(seed)
    return np.repeat(r.normal(size=(n // size, d)) * 10, size, axis=0) + r.normal(size=(n, d))


def assert_nearest(x, got, k, rows, extra=None):
    for i in rows:
        d2 = ((x - x[i]) ** 2).sum(axis=1)
        if extra is not None:
            d2 = d2 + extra(i)
        d = np.sqrt(d2)
        d[i] = np.inf
        want = sorted(range(len(x)), key=lambda j: (d[j], j))[:k]
        own = [got[i, r + 1] for r in range(k)]
        assert own == want or np.allclose(d[own], d[want], rtol=1e-12), i


@pytest.mark.parametrize("d", [17, 37])
def test_exact_and_flat_pairs_on_clustered_rows(spark, d):
    pairs = {}
    for n in (2000, 16000):
        x, stats = clusters(n, d), {}
        df, cols = frame(spark, x)
        got = {(r.left_id, r["rank"]): r.right_id for r in K.knn_join(df, df, cols, 5, stats=stats).collect()}
        assert len(got) == 5 * n
        assert_nearest(x, got, 5, range(0, n, n // 40))
        pairs[n] = stats["pairs"] / n
    assert pairs[16000] < 1.2 * pairs[2000] < 150


def test_exact_without_structure_and_when_blocks_are_cut_again(spark, monkeypatch):
    monkeypatch.setattr(K, "MAX_PIVOTS", 4)
    monkeypatch.setattr(K, "SAMPLE", 50)
    monkeypatch.setattr(K, "SALT", 100)
    x = np.random.default_rng(3).normal(size=(700, 6))
    x[:200] = 3 + x[:200] * 1e-4
    x[200:260] = x[200]
    df, cols = frame(spark, x)
    got = {(r.left_id, r["rank"]): r.right_id for r in K.knn_join(df, df, cols, 4, leaf=8).collect()}
    assert_nearest(x, got, 4, range(0, 700, 9))


def test_payload_counts_in_the_distance_and_null_equals_null(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(400, 3)).round(1)
    w = [["a", "b", None][int(i)] for i in r.integers(0, 3, 400)]
    c = [int(i) for i in r.integers(0, 2, 400)]
    df, cols = frame(spark, x, w=w, c=c)  # columns named like the index's own
    got = {(r.left_id, r["rank"]): r.right_id for r in K.knn_join(df, df, cols, 5, payload=["w", "c"], penalty=0.4).collect()}
    assert_nearest(x, got, 5, range(0, 400, 7), lambda i: np.array([0.4 * ((w[j] != w[i]) + (c[j] != c[i])) for j in range(400)]))


def test_other_rows_and_rows_without_coordinates(spark):
    x = np.random.default_rng(5).normal(size=(300, 4))
    right, cols = frame(spark, x)
    left = right.where("id < 20").withColumn("id", F.col("id") + 1000).unionByName(
        spark.createDataFrame([(5000, None, 1.0, 1.0, 1.0), (5001, float("nan"), 1.0, 1.0, 1.0)], right.schema))
    got = K.knn_join(left, right, cols, 2, exclude_self=False).collect()
    assert {r.left_id for r in got} == set(range(1000, 1020))
    assert all(r.right_id == r.left_id - 1000 and r.dist == 0 for r in got if r["rank"] == 1)
    assert K.knn_join(right.limit(0), right, cols, 2).count() == 0
    assert K.knn_join(right, right.limit(0), cols, 2).count() == 0


def test_lof_over_17_columns(spark):
    x = clusters(600, 17, seed=6)
    x[599] = x[0] + 30
    df, cols = frame(spark, x)
    out = NB.local_outlier_factor(df, cols, k=10, contamination=0.01)
    assert out.orderBy(F.col("lof").desc()).first()["id"] == 599
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    nn = np.argsort(d, axis=1, kind="stable")[:, :10]
    kd = d[np.arange(600), nn[:, -1]]
    lrd = 1 / np.array([np.maximum(kd[nn[i]], d[i, nn[i]]).mean() for i in range(600)])
    want = np.array([lrd[nn[i]].mean() / lrd[i] for i in range(600)])
    got = {r["id"]: r["lof"] for r in out.collect()}
    assert np.allclose([got[i] for i in range(600)], want)


def dbscan(x, eps, m):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = (d <= eps).sum(1) >= m
    return [i for i in range(len(x)) if not core[i] and not (core & (d[i] <= eps)).any()]


def test_dbscan_over_17_columns(spark):
    r = np.random.default_rng(7)
    x = np.vstack([clusters(500, 17, seed=8), r.normal(size=(60, 17)) * 12])
    df, cols = frame(spark, x)
    want = dbscan(x, 6.0, 5)
    assert 20 < len(want) < 200
    assert sorted(r["id"] for r in NB.dbscan_noise(df, cols, 6.0, 5).collect()) == want


def test_sparse_point_beside_a_packed_cloud_costs_blocks(spark):
    """Blocks wholly within epsilon are counted, not compared."""
    r = np.random.default_rng(9)
    pairs = {}
    for n in (1000, 8000):
        cloud = r.normal(size=(n, 5)) * 1e-3
        cloud[:, 0] += 0.5
        x = np.vstack([cloud, [[0.0] * 5, [-0.8] + [0.0] * 4, [5.0] * 5]])
        df, cols = frame(spark, x)
        stats = {}
        got = sorted(q["id"] for q in NB.dbscan_noise(df, cols, 0.7, 20, stats=stats).collect())
        assert got == [n + 1, n + 2]
        pairs[n] = stats["pairs"]
    assert pairs[8000] < 500


def labelled(spark, n=300, seed=2):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 17))
    y = [1 if v < 0.15 else 0 for v in r.random(n)]
    return frame(spark, x, y=pd.array([None if i % 50 == 7 else v for i, v in enumerate(y)], dtype="Int64"), town=[f"t{i % 4}" for i in range(n)],
                 flag=[i % 3 == 0 for i in range(n)], note=[f"n{i}" for i in range(n)])


def test_resamplers_balance_and_keep_all_columns(spark):
    df, cols = labelled(spark)
    n = {r["y"]: r["count"] for r in df.groupBy("y").count().collect()}
    rows = {r["id"]: r for r in df.collect()}
    for out in (NB.smote(df, cols, "y", seed=1), NB.smote_nc(df, cols, ["town", "flag"], "y", seed=1), NB.adasyn(df, cols, "y", seed=1)):
        assert out.columns == [*df.columns, "synthetic", "parent_id", "copy"]
        got = out.collect()
        assert sum(not r["synthetic"] for r in got) == df.count()
        syn = [r for r in got if r["synthetic"]]
        assert {r["y"] for r in syn} == {1} and all(r["id"] is None and rows[r["parent_id"]]["y"] == 1 for r in syn)
        assert abs(len(syn) - (n[0] - n[1])) <= n[1]  # ADASYN rounds each parent's copies
        mino = np.array([[r[c] for c in cols] for r in rows.values() if r["y"] == 1])
        s = np.array([[r[c] for c in cols] for r in syn])
        assert (s >= mino.min(axis=0) - 1e-9).all() and (s <= mino.max(axis=0) + 1e-9).all()
        assert all(r["note"] == rows[r["parent_id"]]["note"] for r in syn)
    assert len([r for r in NB.smote(df, cols, "y", seed=1).collect() if r["synthetic"]]) == n[0] - n[1]


def test_smote_nc_takes_the_neighbours_mode(spark):
    df, cols = labelled(spark)
    m = [r for r in df.collect() if r["y"] == 1]
    x = np.array([[r[c] for c in cols] for r in m])
    pen = np.median(x.std(axis=0)) ** 2 / 2
    by_id = {}
    for i, r in enumerate(m):
        d = ((x - x[i]) ** 2).sum(axis=1) + pen * np.array([(o["town"] != r["town"]) + (o["flag"] != r["flag"]) for o in m])
        d[i] = np.inf
        near = [m[j] for j in sorted(range(len(m)), key=lambda j: (d[j], m[j]["id"]))[:5]]
        by_id[r["id"]] = tuple(min({o[c] for o in near}, key=lambda v: (-sum(o[c] == v for o in near), v)) for c in ("town", "flag"))
    syn = NB.smote_nc(df, cols, ["town", "flag"], "y", seed=1).where("synthetic").collect()
    assert syn and all((r["town"], r["flag"]) == by_id[r["parent_id"]] for r in syn)


def test_smote_nc_over_37_columns(spark):
    x = clusters(400, 30, seed=3)
    df, cols = frame(spark, x, y=[int(i % 5 == 0) for i in range(400)], **{f"c{j}": [f"v{(i * (j + 1)) % 3}" for i in range(400)] for j in range(7)})
    out = NB.smote_nc(df, cols, [f"c{j}" for j in range(7)], "y")
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 320, 1: 320}


def test_labels_that_leave_nothing_to_balance(spark):
    df, cols = frame(spark, np.random.default_rng(1).normal(size=(6, 2)), y=pd.array([None] * 6, dtype="Int64"))
    tie = df.withColumn("y", F.when(F.col("id") < 2, 0).when(F.col("id") < 4, 1))  # two of each, two without
    for d in (df, tie, df.withColumn("y", F.lit(1)), df.limit(0)):
        for f in (NB.smote, NB.adasyn, lambda a, b, c: NB.smote_nc(a, b, [], c)):
            assert f(d, cols, "y").where("synthetic").count() == 0


@pytest.mark.parametrize("what", ["knn", "dbscan"])
def test_no_table_holds_a_row_for_each_block_that_a_query_meets(spark, monkeypatch, what):
    """Rows without structure meet nearly all blocks; what is written follows the rows all the same, and is exact."""
    n, sizes, real = 1500, {}, K.written

    def spy(df, tag):
        out = real(df, tag)
        sizes[tag] = max(sizes.get(tag, 0), out.count())
        return out
    monkeypatch.setattr(K, "written", spy)
    monkeypatch.setattr(K, "LEAF", 8)
    monkeypatch.setattr(K, "FEW", 64)
    x = np.random.default_rng(11).random((n, 17))
    df, cols = frame(spark, x)
    if what == "knn":
        got = {(r.left_id, r["rank"]): r.right_id for r in K.knn_join(df, df, cols, 2, leaf=8).collect()}
        assert_nearest(x, got, 2, range(0, n, 50))
    else:
        assert sorted(r["id"] for r in NB.dbscan_noise(df, cols, 1.0, 4).collect()) == dbscan(x, 1.0, 4)
    assert max(sizes.values()) <= 4 * n, sizes
