import pytest

from prepforge.llm.mixing import mix, source_targets, systematic_copies


def loop_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(k for k in sizes if k is not None) + ([None] if None in sizes else [])
    w = {k: weights[i % 3] for i, k in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [k for k in names if k not in held]
        left = total - sum(held.values())
        t = {k: left * w[k] / sum(w[j] for j in free) for k in free}
        over = [k for k in free if t[k] > most * sizes[k] + 1e-9]
        if not over:
            return {**t, **held}
        held.update({k: most * sizes[k] for k in over})


def docs(spark):
    rows = [(i, " ".join(["w"] * (i % 37)), f"s{i % 4}" if i % 9 else None, f"l{i}") for i in range(900)]
    rows += [(5000 + i, " ".join(["x"] * 5), "tiny", "z") for i in range(3)] + [(6000, None, "none", "z")]
    rows += [(7000, "same text here", "s1", "q")] * 4
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


def test_targets_equal_the_loop(spark):
    sizes = {"a": 1000, "b": 3, "c": 50, "d": 700, None: 1, "e": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(df).collect()}
    assert got == pytest.approx(loop_targets(sizes))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_taken_words_follow_targets(spark):
    a = systematic_copies(spark, docs(spark)).collect()
    by = {}
    for r in a:
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] <= 3
        s = by.setdefault(r["source"], [0, r["target"], 0])
        s[0] += r["taken"]
        s[2] = max(s[2], r["size"])
    for taken, target, most in by.values():
        assert abs(taken - target) <= 2 * most + 1
    b = systematic_copies(spark, docs(spark).repartition(3)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_mix_emits_the_copies(spark):
    want = {}
    for r in systematic_copies(spark, docs(spark)).collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["copies"]
    got = mix(spark, docs(spark))
    assert got.columns == ["doc_id", "text", "source", "size"]
    have = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert have == {k: v for k, v in want.items() if v}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert systematic_copies(spark, df).count() == 0 and mix(spark, df).count() == 0


def test_mix_keeps_clashing_columns_and_tells_null_from_empty(spark):
    rows = [(1, None, "a", 1), (1, "", "a", 2)] + [(10 + i, "w " * 20, "a", i) for i in range(20)] + [(50 + i, "v " * 5, "b", i) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _i int") \
        .selectExpr("*", "_i as _h", "_i as _n", "'r' as row", "_i + 7 as id", "'x' as src", "9 as h", "_i as size", "_i as text_hash", "_i as _doc_id")
    out = mix(spark, df)
    assert out.columns == df.columns
    own = {r["doc_id"]: r for r in df.where("doc_id > 1").collect()}
    got = out.collect()
    assert got and all(r == own[r["doc_id"]] for r in got if r["doc_id"] > 1)
    n = {(r["doc_id"], r["text_hash"]): r["copies"] for r in systematic_copies(spark, df.drop("size", "text_hash")).where("doc_id = 1").collect()}
    assert len(n) == 2
    for text, i in ((None, 1), ("", 2)):
        same = [r for r in got if r["doc_id"] == 1 and r["text"] == text]
        assert {r["_i"] for r in same} <= {i}
    assert sum(r["doc_id"] == 1 for r in got) == sum(n.values())
    assert mix(spark, df.limit(0)).collect() == []
