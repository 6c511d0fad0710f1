"""Hand-worked micro tables for the semantic traps (FIXTURES.md §C)."""

import math

from pyspark.sql import functions as F

from prepforge.functions.exprs import safe_ratio
from prepforge.operators import clean as C
from prepforge.operators import evaluate as EV
from prepforge.operators import outliers as O
from prepforge.operators import scale as S
from prepforge.operators import select as SEL


def test_null_category_survives_block_list(spark):
    df = spark.createDataFrame([(1, "YOLO"), (2, None), (3, "Married"), (4, "Alone")], "id long, marital_status string")
    got = sorted(r.id for r in C.drop_unusual_classes(df).collect())
    assert got == [2, 3]


def test_constant_column(spark):
    df = spark.createDataFrame([(i, 5.0, float(i)) for i in range(5)], "id long, x double, y double")
    m = S.fit_minmax(df, ["x", "y"])
    out = m.transform(df).orderBy("id").collect()
    assert all(r.x == 0.0 for r in out)
    assert [r.y for r in out] == [0.0, 0.25, 0.5, 0.75, 1.0]
    # MAD = 0 and value on the median: not flagged
    assert O.outlier_robust_z(df, ["x"]).count() == 0


def test_mad_zero_flags_off_median(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 0.0), (4, 0.0), (5, 7.0)], "id long, x double")
    assert [r.id for r in O.outlier_robust_z(df, ["x"]).collect()] == [5]


def test_zero_denominators(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.0), (3, None, 1.0), (4, 3.0, 2.0)], "id long, a double, b double")
    got = {r.id: r.q for r in df.select("id", safe_ratio("a", "b").alias("q")).collect()}
    assert got == {1: 0.0, 2: 0.0, 3: 0.0, 4: 1.5}


def test_iqr_fence_is_strict(spark):
    # 1..8: Q1 = 2.75, Q3 = 6.25, IQR = 3.5, upper fence 11.5 (not flagged), 11.6 is
    vals = [1, 2, 3, 4, 5, 6, 7, 8]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id long, s double")
    assert O.outlier_iqr_scores(df, "s").count() == 0
    df2 = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals + [40])], "id long, s double")
    assert [r.id for r in O.outlier_iqr_scores(df2, "s").collect()] == [8]


def test_unknown_level_all_zero(spark):
    tr = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "id long, c string")
    un = spark.createDataFrame([(4, "A"), (5, "D")], "id long, c string")
    m = C.fit_one_hot(tr, ["c"])
    rows = {r.id: r.asDict() for r in m.transform(un).collect()}
    assert rows[4]["c_A"] == 1 and rows[4]["c_B"] == 0
    assert rows[5]["c_A"] == 0 and rows[5]["c_B"] == 0
    assert "c_C" not in rows[5]


def test_auroc_with_ties(spark):
    # pos scores 0.8, 0.5 ; neg scores 0.5, 0.2 -> pairs: (0.8>0.5)=1,(0.8>0.2)=1,(0.5=0.5)=.5,(0.5>0.2)=1
    df = spark.createDataFrame([(1, 0.8), (1, 0.5), (0, 0.5), (0, 0.2)], "y int, s double")
    assert EV.auroc(df, "y", "s").first()["auroc"] == 3.5 / 4


def test_threshold_equality_counts_positive(spark):
    df = spark.createDataFrame([(1, 0.05), (0, 0.05), (1, 0.0)], "y int, s double")
    cm = EV.confusion(df, "y", "s", 0.05).first()
    assert (cm.tn, cm.fp, cm.fn, cm.tp) == (0, 1, 1, 1)
    curve = {round(r.threshold, 3): r.profit for r in EV.profit_curve(df, "y", "s").collect()}
    assert curve[0.0] == 11 * 2 - 3 * 3
    assert curve[0.05] == 11 * 1 - 3 * 2


def test_yates_two_by_two(spark):
    # table [[10, 20], [30, 40]] -> scipy chi2_contingency (corrected) = 0.4464...
    rows = [(0.0, 0)] * 10 + [(0.0, 1)] * 20 + [(1.0, 0)] * 30 + [(1.0, 1)] * 40
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], "id long, x double, y int")
    r = SEL.rank_chi2(df, [], ["x"], "y").first()
    n, a, b, c, d = 100, 10, 20, 30, 40
    exp = n * (abs(a * d - b * c) - n / 2) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d))
    assert abs(r.chi2 - round(exp, 6)) < 1e-6 and r.dof == 1


def test_info_gain_best_split(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (3.0, 1), (4.0, 1)], "x double, y int")
    best = SEL.rank_info_gain(df, ["x"], "y").first()
    assert best.best_value == 2.0 and abs(best.gain - 1.0) < 1e-9
    single = spark.createDataFrame([(1.0, 0), (1.0, 1)], "x double, y int")
    assert SEL.info_gain_splits(single, "x", "y").count() == 0


def test_votes_and_info(spark):
    flags = spark.createDataFrame(
        [("z", 1, "a"), ("z", 1, "b"), ("r", 1, "a"), ("z", 2, "a"), ("box", 3, "multi/unknown")],
        "detector string, id long, var string")
    v = {r.id: (r.votes, r.score) for r in O.outlier_votes(flags).collect()}
    assert v == {1: (3, 1.0), 2: (1, 0.0), 3: (1, 0.0)}
    info = {r.id: r.vars for r in O.outlier_info(flags).collect()}
    assert info[1] == "a,b" and info[3] == "multi/unknown"


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, x double, y int")
    assert C.dedupe_exact(df).count() == 0
    assert EV.confusion(df, "y", "x", 0.5).first().tp == 0


def test_label_conflict_groups(spark):
    df = spark.createDataFrame([(1, 1, None, 0), (2, 1, None, 0), (3, 2, 5, 0), (4, 2, 5, 1), (5, 3, 1, 1)],
                               "id long, a int, b int, label int")
    kept = sorted(r.id for r in C.drop_label_conflicts(df, "label").collect())
    assert kept == [1, 2, 5]
    assert sorted(r.id for r in C.dedupe_exact(df.drop("label")).collect()) == [1, 3, 5]
