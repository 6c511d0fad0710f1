import numpy as np
import pyarrow as pa

from prepforge.llm import quality as Q


def corpus(n=400):
    r = np.random.default_rng(2)
    words = ["river", "house", "of", "the", "And", "stone,", "green.", "walk", "day", "night", "over", "small", "x2", "éa", "long"]
    words += [f"{a}{b}" for a in ("ba", "co", "du", "fe") for b in ("rin", "lat", "mon", "ser", "tig")]
    rows, bad = [], set()
    for i in range(n):
        w = list(r.choice(words, int(r.integers(25, 60))))
        k = i % 10
        if k == 0:
            w = [x + "&&&" for x in w]
        if k == 1:
            w = [x.upper() + "!!" for x in w]
        if k == 2:
            w = [x for x in w[:4] for _ in range(12)]
        if k == 3 and i % 20 == 3:
            w = [y for x in w for y in (x, "|")]
        if k < 3 or k == 3 and i % 20 == 3:
            bad.add(i)
        rows.append((i, " ".join(w)))
    return rows, bad


def test_em_finds_the_accuracies():
    r = np.random.default_rng(0)
    y = r.random(40000) < .7
    acc, talk = np.array([.95, .8, .7, .9, .6]), np.array([.9, .7, .8, .5, .9])
    right = r.random((len(y), 5)) < acc
    v = np.where(r.random((len(y), 5)) < talk, np.where(right, 1, -1) * np.where(y, 1, -1)[:, None], 0)
    patterns, inv, counts = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    post, table, prior = Q.label_model(patterns, counts.astype(float))
    assert abs(prior - .7) < .05
    for j in range(5):
        assert abs(table[1, j, 2] / (table[1, j, 2] + table[1, j, 0]) - acc[j]) < .05
    assert ((post[inv.ravel()] >= .5) == y).mean() > .93


def test_shares_equal_brute_force():
    texts = ["a a a b", "", "X&&& YY zz", "l1 x\nl2 y\nl1 x\n\n", "| a | b", "ÉÀ 12 ok"]
    got, n, *_ = Q.shares(pa.array(texts))
    for t, row, m in zip(texts, got, n):
        w = t.split()
        assert m == len(w)
        if w:
            lines = [x for x in t.split("\n") if x]
            want = [sum("&&" in x for x in w), sum(sum(c.isupper() for c in x) >= 2 and not any(c.islower() for c in x) for x in w),
                    sum(a == b for a, b in zip(w, w[1:])), len(set(w)), sum(x == "|" for x in w)]
            assert np.allclose(row[:5], np.array(want) / len(w))
            assert np.isclose(row[5], 1 - len(set(lines)) / len(lines))


def test_rejects_the_bad_and_keeps_the_good(spark):
    rows, bad = corpus()
    odd = [(1000, None), (1001, ""), (1002, "one"), (1003, "word " * 1), (None, "the river of the house"), (5, rows[5][1])]
    df = spark.createDataFrame([(d, t, "z", 1.0) for d, t in rows + odd], "doc_id long, text string, keep string, score double")
    labels = spark.createDataFrame([(i, int(i not in bad), 0) for i in range(0, 400, 3)] + [(0, 0, 0)], "doc_id long, quality int, toxic int")
    w, by = Q.fit(spark, df, labels)
    assert by and all(0 <= p <= 1 for p in by.values())
    got = Q.quality_scores(spark, df, w).collect()
    assert len(got) == len(rows) + len(odd)
    keep = {r["doc_id"]: r["keep"] for r in got}
    assert sum(keep[i] == (i not in bad) for i, _ in rows) >= 0.98 * len(rows)
    assert not keep[1000] and not keep[1001] and all(0 <= r["score"] <= 1 for r in got)
    kept = Q.keep_good(spark, df, w)
    assert kept.columns == df.columns and kept.count() == sum(r["keep"] for r in got)
    w2, _ = Q.fit(spark, df.repartition(5), None)
    assert len(w2) == Q.N_FEATURES + 1


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    w, by = Q.fit(spark, df, None)
    assert by == {} and Q.quality_scores(spark, df, w).count() == 0 and Q.keep_good(spark, df, w).count() == 0
