"""Constant columns, one class, null groups and labels, empty and all-null columns."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from prepforge.operators import clean, evaluate, features, multivariate, neighbors, profile, sample, scale, select


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, 5.0, float(i % 7), None if i % 4 == 0 else "ab"[i % 2], None if i % 5 == 0 else i % 2) for i in range(40)]
    return spark.createDataFrame(rows, "id long, const double, x double, g string, label int")


def test_null_group_has_quartiles(odd):
    got = {(r["g"], r["var"]): r for r in profile.describe_by_group(odd, ["x"], "g").collect()}
    pdf = odd.toPandas()
    own = pdf[pdf.g.isna()].x
    assert got[(None, "x")]["p50"] == own.median() and got[(None, "x")]["p25"] == own.quantile(0.25)
    five = {(r["var"], r["label"]): r for r in profile.five_number_by_label(odd, ["x"], "label").collect()}
    assert five[("x", None)]["median"] == pdf[pdf.label.isna()].x.median()


def test_constant_column_has_no_correlation(odd):
    got = {r["var"]: r["abs_corr"] for r in profile.corr_with_label(odd, ["const", "x"], "label").collect()}
    pdf = odd.toPandas()
    assert got["const"] is None and abs(got["x"] - abs(pdf.x.corr(pdf.label))) < 1e-6
    for df in (odd, odd.na.drop()):  # with and without nulls: one algorithm
        m = {(r["var1"], r["var2"]): r["abs_corr"] for r in profile.corr_matrix(df, ["const", "x", "label"]).collect()}
        assert m[("const", "const")] is None and m[("const", "x")] is None and m[("x", "x")] == 1.0
        own = df.toPandas()
        assert abs(m[("x", "label")] - abs(own.x.corr(own.label))) < 1e-6


def test_one_class(odd):
    one = odd.where("label = 1")
    assert [r["f"] for r in select.rank_anova_f(one, ["x"], "label").collect()] == [None]
    assert evaluate.auroc(one, "label", "x").first()["auroc"] is None


def test_null_labels_are_a_class(odd):
    s = {(r["label"], r["split"]): r["count"] for r in sample.split_stratified(odd, "label", 0.25).groupBy("label", "split").count().collect()}
    assert s == {(None, "test"): 2, (None, "train"): 6, (0, "test"): 4, (0, "train"): 12, (1, "test"): 4, (1, "train"): 12}
    folds = sample.kfold_stratified(odd, "label", 4)
    assert folds.where("fold is null").count() == 0
    assert {r["count"] for r in folds.where("label is null").groupBy("fold").count().collect()} == {2}


def test_empty_and_all_null_columns(spark, odd):
    none = odd.withColumn("y", odd["x"]).withColumn("x", F.lit(None).cast("double"))
    m = scale.fit_minmax(none, ["x", "y"]).transform(none)
    assert m.where("x is not null").count() == 0 and m.where("y is null").count() == 0
    b = features.fit_uniform_bins(none, ["x", "const"]).transform(none)
    assert b.where("x_bin is not null").count() == 0
    c = features.fit_uniform_bins(odd.withColumn("const", odd["const"] * (odd["label"] + 1 - odd["label"])), ["const"])
    got = c.transform(odd.withColumn("const", odd["const"] * (odd["label"] + 1 - odd["label"])))
    assert got.where("(const is null) <> (const_bin is null)").count() == 0
    empty = odd.limit(0)
    assert scale.fit_minmax(empty, ["x"]).transform(empty).count() == 0


def test_equal_rows_have_factor_one(spark):
    rows = [(i, 1.0, 1.0) for i in range(9)] + [(100 + i, float(i), float(-i)) for i in range(6)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    got = {r["id"]: r["lof"] for r in neighbors.local_outlier_factor(df, ["x", "y"], k=4, contamination=0.2).collect()}
    # brute force with ties by id
    ids, pts = [r[0] for r in rows], np.array([r[1:] for r in rows])
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(-1))
    nn = [sorted((j for j in range(len(rows)) if j != i), key=lambda j: (d[i, j], ids[j]))[:4] for i in range(len(rows))]
    kd = [max(d[i, j] for j in nn[i]) for i in range(len(rows))]
    lrd = [1 / max(np.mean([max(kd[j], d[i, j]) for j in nn[i]]), 1e-10) for i in range(len(rows))]
    for i, k in enumerate(ids):
        assert np.isclose(got[k], np.mean([lrd[j] for j in nn[i]]) / lrd[i])
    assert got[0] == 1.0


def test_perfect_fit_has_no_distance(spark):
    df = spark.createDataFrame([(i, float(i + 1), 2.0 * (i + 1)) for i in range(5)], "id long, x double, y double")
    assert [r["cooks_d"] for r in multivariate.cooks_distance(df, "y", ["x"]).collect()] == [None] * 5


def test_label_codes_of_many_levels(spark):
    df = spark.range(13000).selectExpr("id", "concat('v', cast(12999 - id as string)) c").unionByName(
        spark.createDataFrame([(20000, "v5"), (20001, None)], "id long, c string"))
    codes = clean.fit_label_codes(df, ["c"])
    out = {r["id"]: r["c"] for r in codes.encode(df).collect()}
    assert out[0] == 0 and out[12999] == 12999 and out[20000] == out[12994] and out[20001] is None
    back = {r["id"]: r["c"] for r in codes.decode(codes.encode(df)).collect()}
    assert back[77] == "v12922" and back[20001] is None


def test_envelope_finds_outliers_that_mask_one_another(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(800, 5)) @ np.diag([1, 2, 1, 0.5, 3])
    x[:200] = x[:200] + np.array([9, -14, 9, 4, 20])
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)] + [(9999, None, 0.0, 0.0, 0.0, 0.0)], "id long, a double, b double, c double, d double, e double")
    out = multivariate.elliptic_envelope(df, list("abcde"), contamination=0.25).collect()
    assert {r["id"] for r in out if r["flagged"]} == set(range(200)) and len(out) == 800
    # the classical moments are pulled towards them and miss most
    from prepforge.functions.stats import pinv
    _, mu, cov = multivariate.moments(df.where("id < 800"), list("abcde"))
    d = np.einsum("ij,jk,ik->i", x - mu, pinv(cov), x - mu)
    assert len(set(np.argsort(-d)[:200]) & set(range(200))) < 150
    mean, _ = multivariate.fit_mcd(df, list("abcde"))
    assert np.abs(mean - x[200:].mean(axis=0)).max() < 0.6


def test_discriminant_has_one_sign(spark):
    r = np.random.default_rng(5)
    rows = [(i, *map(float, r.normal(size=3) + (i % 2) * np.array([2, -1, 0])), i % 2) for i in range(200)] + [(999, 0.0, 0.0, 0.0, None)]
    df = spark.createDataFrame(rows, "id long, x double, y double, z double, label int")
    for part in (df, df.repartition(7)):
        _, dirs, ratio = multivariate.fit_lda(part, ["x", "y", "z"], "label")
        assert dirs.shape == (3, 1) and dirs[0, 0] > 0 > dirs[1, 0] and abs(dirs[0, 0]) == np.abs(dirs).max() and ratio[0] == 1


def test_wide_quantiles_equal_numpy(spark, monkeypatch):
    from prepforge.plans import prefix
    r = np.random.default_rng(0)
    x = np.column_stack([r.normal(size=4000).round(2), np.where(r.random(4000) < 0.6, 3.0, r.random(4000)), r.integers(0, 5, 4000)]).astype(float)
    df = spark.createDataFrame([(*map(float, v), None) for v in x] + [(None, None, None, None)], "a double, b double, c double, none double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.975, 1.0]
    for accuracy in (10_000, 100):
        monkeypatch.setattr(prefix, "ACCURACY", accuracy)
        got = prefix.wide_quantiles(df, ["a", "b", "c", "none"], probs)
        for j, c in enumerate("abc"):
            for p in probs:
                assert np.isclose(got[c, p], np.percentile(x[:, j], 100 * p), atol=1e-12), (c, p)
            assert got["none", 0.5] is None
    monkeypatch.setattr(prefix, "BRACKET_ROWS", 10)
    assert np.isclose(prefix.wide_quantiles(df, ["a"], [0.3])["a", 0.3], np.percentile(x[:, 0], 30))
    assert prefix.wide_quantiles(df.limit(0), ["a"], [0.5]) == {("a", 0.5): None}
