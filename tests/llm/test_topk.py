import numpy as np

from prepforge.llm import topk as K


def brute(queries, rows, top=5):
    v = [(i, K.quantise(e)) for i, e in rows if i is not None and K.quantise(e) is not None]
    out = []
    for qi, e in queries:
        q = K.quantise(e)
        if qi is None or q is None:
            continue
        s = sorted((-sum(int(a) * int(b) for a, b in zip(q, x)), i) for i, x in v if i != qi)
        out += [(qi, r + 1, i, -t) for r, (t, i) in enumerate(s[:top])]
    return sorted(out)


def table(n=700, d=12, seed=0):
    r = np.random.default_rng(seed)
    centers = r.normal(0, .3, (20, d))
    rows = [(int(i), (centers[i % 20] + r.normal(0, .05, d)).tolist()) for i in r.permutation(n)]
    rows += [(5000 + i, [0.5] * d) for i in range(20)]  # ties
    rows += [(6000, None), (6001, [None] * d), (6002, [float("nan")] * d), (6003, [0.0] * d), (6004, [float("inf")] * d), (6005, [-.2, .3])]
    rows += [(None, [1.0] * d), (3, rows[0][1]), (50000, [-0.4] * d)]
    return rows


def test_equal_brute_force(spark, monkeypatch):
    for block in (64, 4096):
        monkeypatch.setattr(K, "BLOCK", block)
        monkeypatch.setattr(K, "QUERY_BLOCK", 9)
        rows = table()
        queries = [(i, e) for i, e in rows if i is None or i % 50 == 0 or i in (5003, 6003)]
        v = spark.createDataFrame([(*x, "z") for x in rows], "vec_id long, embedding array<double>, score string")
        q = spark.createDataFrame(queries, "query_id long, embedding array<double>")
        got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in K.top_inner(spark, q, v).collect())
        assert got == brute(queries, rows)


def test_block_search_stops_on_proof_only(monkeypatch):
    r = np.random.default_rng(3)
    seen = set()
    for t in range(60):
        monkeypatch.setattr(K, "FEW", (0, 5, 64, 1000)[t % 4])
        x = r.integers(-140, 140, (int(r.integers(1, 400)), 8))
        ids = r.permutation(1000)[:len(x)]
        b = K.Block(ids, x, int(r.integers(1, 70)))
        q = r.integers(-140, 140, (7, 8)) * (r.random((7, 8)) < .8)
        own = r.choice(ids, 7)
        plain = b.search(q, own, 5, [None] * 7)
        for i in range(7):
            want = sorted(zip((-(x @ q[i])).tolist(), ids.tolist()))
            want = [w for w in want if w[1] != own[i]][:5]
            got, score, passes = plain[i]
            seen.add(passes)
            assert list(zip((-score).tolist(), got.tolist())) == want
            if len(want) == 5:
                floor = -want[2][0]
                got, score, _ = b.search(q[i:i + 1], own[i:i + 1], 5, [floor])[0]
                keep = [(a, j) for a, j in zip((-score).tolist(), got.tolist()) if -a >= floor]
                assert keep == [w for w in want if -w[0] >= floor]
    assert seen == {1, 2}


def test_few_and_empty(spark):
    s = "vec_id long, embedding array<double>"
    v = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (50, [1.0])], s)
    q = v.where("vec_id = 50").withColumnRenamed("vec_id", "query_id")
    assert [tuple(r) for r in K.top_inner(spark, q, v).orderBy("rank").collect()] == [(50, 1, 2, 131072), (50, 2, 1, 65536)]
    assert K.top_inner(spark, q.limit(0), v).count() == 0 and K.top_inner(spark, q, v.limit(0)).count() == 0
