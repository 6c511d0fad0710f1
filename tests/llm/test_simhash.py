import numpy as np
import pyarrow as pa
import pytest
import xxhash

from prepforge.llm.simhash import Anchors, drop_near_copies, fingerprints, near_links, one_of_each_group, simhash_groups


def slow(text, k=3):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def texts():
    r = np.random.default_rng(3)
    words = [f"w{i}" for i in range(40)]
    out = [None, "", "  \t ", "One", "one two", "A b C", "é È ñ x" * 3, "x " * 700, "a b c d " * 900]
    base = [str(x) for x in r.choice(words, 300)]
    for i in range(30):
        b = list(base)
        for j in r.integers(0, 300, i % 4):
            b[j] = "changed"
        out.append(" ".join(b))
    out += [" ".join(r.choice(words, int(n))) for n in r.integers(1, 30, 60)]
    return out


def test_fingerprints_equal_brute_force():
    t = texts()
    got = fingerprints(pa.array([x or "" for x in t]))
    assert [int(x) for x in got] == [slow(x) for x in t]


def test_every_close_pair_meets_at_an_anchor():
    a, r = Anchors(2), np.random.default_rng(1)
    x = r.integers(0, 2 ** 63, 3000).astype(np.uint64) * np.uint64(2) + r.integers(0, 2, 3000).astype(np.uint64)
    bits = r.integers(0, 64, (2, 3000)).astype(np.uint64)
    y = x ^ (np.uint64(1) << bits[0]) ^ (np.uint64(1) << bits[1])
    home = a.home(x)
    row, anchor = a.covering(y)
    met = np.zeros(3000, bool)
    met[row[anchor == home[row]]] = True
    assert met.all()
    assert np.bitwise_count((x ^ home.astype(np.uint64)) & np.uint64(2 ** 23 - 1)).max() <= 3


def brute(rows):
    fp = [slow(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(fp[i] ^ fp[j]).count("1") <= 2:
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, f"{fp[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows))


def test_groups_equal_brute_force(spark):
    rows = [(100 - i, t) for i, t in enumerate(texts())] + [(7, "x y z"), (7, "x y z")]
    df = spark.createDataFrame([(d, t, "fp", 1) for d, t in rows], "doc_id long, text string, fp string, anchor int")
    got = simhash_groups(spark, df).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows)
    kept = [r["doc_id"] for r in drop_near_copies(spark, df).collect()]
    assert sorted(kept) == sorted({c for _, _, c in brute(rows)})


def test_empty_and_null_ids(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_groups(spark, df).count() == 0
    df = spark.createDataFrame([(None, "only one here"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash_groups(spark, df).collect()}
    assert got == {None: None, 3: 3}


def test_each_group_keeps_one_row_whatever_its_ids(spark):
    a, b, c, d = ("a b c d e f g", "one two three four five", "red green blue cyan", "sun moon star sky")
    rows = [(3, a, None), (5, a, "x"), (5, b, "x"), (None, c, "x"), (None, c, None), (None, d, "y"), (9, d, "y"), (9, d, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = [tuple(r) for r in one_of_each_group(spark, df).collect()]
    assert sorted((t, i) for i, t, _ in got if i is not None) == sorted([(a, 3), (b, 5), (d, 9)])
    assert [t for i, t, _ in got if i is None] == [c]
    assert sorted(map(str, map(tuple, drop_near_copies(spark, df).collect()))) == sorted(map(str, got))
    twice = spark.createDataFrame([(5, a), (5, b)], "doc_id long, text string")
    assert sorted(r["text"] for r in one_of_each_group(spark, twice).collect()) == sorted([a, b])


def test_clashing_columns_come_through(spark):
    rows = [(i, "same text for everyone here" if i % 2 else f"text number {i} alone {i * 7}", i) for i in range(10)] + [(None, "", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _k1 int").selectExpr("*", "_k1 as _k2", "_k1 as fp", "_k1 as part", "'r' as row", "_k1 as least")
    for keep in (one_of_each_group, drop_near_copies):
        out = keep(spark, df)
        assert out.columns == df.columns
        got = {r["doc_id"]: r for r in out.collect()}
        own = {r["doc_id"]: r for r in df.collect()}
        assert set(got) == {0, 1, 2, 4, 6, 8, None} and all(r == own[i] for i, r in got.items())
        assert keep(spark, df.limit(0)).collect() == []


def test_no_side_of_the_anchor_join_is_broadcast(spark):
    # each fingerprint goes to some 61 anchors, which Spark's size of the table knows nothing of
    links = near_links(spark, spark.createDataFrame([(1,), (3,), (7 << 40,)], "fp long"))
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert [tuple(r) for r in links.collect()] == [(1, 3)]
