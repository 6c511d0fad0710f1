import re
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa

from prepforge.llm.filter_audit import FILTERS, OP12_SQL, audit, flagged, repeat_bits, places, text_masks


def slow_mask(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    caps = sum("A" <= c <= "Z" for c in text)
    f = (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * caps > 5 * len(text), any(c in "#$%&*|" for c in text))
    return sum(1 << i for i, x in enumerate(f) if x)


def texts(n=200):
    r = np.random.default_rng(4)
    base = [" ".join(r.choice([f"w{i}" for i in range(90)], 60)) for _ in range(12)]
    out = [None, "", "  ", "ÀÉ " * 40, "a" * 95 + "BBBBB", "a" * 94 + "BBBBBB", " ".join(f"u{i}" for i in range(50)), " ".join(f"u{i}" for i in range(49))]
    for i in range(n):
        t = base[int(r.integers(0, 12))]
        out.append([t, t + f" {i}", t.upper(), t + " 50%", f"{i} short", " ".join(f"q{i}x{j}" for j in range(60))][int(r.integers(0, 6))])
    return out


def test_masks_equal_brute_force():
    t = texts()
    arr = pa.array([x or "" for x in t])
    assert text_masks(arr).tolist() == [slow_mask(x or "") for x in t]
    assert text_masks(arr.slice(5, 40)).tolist() == [slow_mask(x or "") for x in t[5:45]]


def rows():
    t = texts()
    out = [(i, x, f"s{i % 3}" if i % 7 else ("" if i % 2 else None)) for i, x in enumerate(t)]
    out += [(50, "twice the id", "s1"), (50, "twice the id", "s1"), (51, "twice the id", "s0"), (None, "no id", "s1"), (None, "no id", None), (60, "no id", "s2")]
    out += [(1000 + i, "a hot text", "hot") for i in range(150)]
    return out


LABELS = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 300, 3)] + [(3, 0, 1), (None, 1, 1), (1003, 1, 1), (99999, 1, 0)]


def test_flags_equal_brute_force_at_any_size_of_sketch(spark):
    data = rows()
    df = spark.createDataFrame([(i, t, s, 0, "x") for i, t, s in data], "doc_id long, text string, source string, mask int, part string").repartition(6)
    least = {}
    for i, t, _ in data:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    want = sorted((str(i), s or "", slow_mask(t or "") + (16 if i is not None and i > least[t or ""] else 0)) for i, t, s in data)
    for counters in (16, 1):
        got = sorted((str(r["doc_id"]), r["part"], r["mask"]) for r in flagged(spark, df, counters).collect())
        assert got == want


def test_sketch_keeps_every_repeat(spark):
    r = np.random.default_rng(1)
    h = r.integers(-2 ** 63, 2 ** 63, 4000)
    h[3000:] = h[:1000]
    for m in (1 << 16, 1 << 18):
        bits = repeat_bits(spark, spark.createDataFrame([(int(x),) for x in h], "h long").repartition(5), m)
        maybe = np.ones(len(h), bool)
        for p in places(h, m):
            maybe &= (bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
        assert maybe[:1000].all() and maybe[3000:].all() and maybe[1000:3000].mean() < 0.2


def test_equals_definition_and_sql(spark):
    data = rows()
    df = spark.createDataFrame([(i, t, s, 9) for i, t, s in data], "doc_id long, text string, source string, kept int")
    lab = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
           for r in audit(spark, df, lab).collect()}
    good = {i for i, q, _ in LABELS if q == 1 and i is not None}
    toxic = {i for i, _, t in LABELS if t == 1 and i is not None}
    docs = [(r["doc_id"], r["part"], r["mask"]) for r in flagged(spark, df).collect()]
    parts = {p for _, p, _ in docs}
    want = {}
    for p in parts:
        for o in permutations(FILTERS):
            alive = [(i, m) for i, q, m in docs if q == p]
            for s, x in enumerate(o):
                bit = 1 << FILTERS.index(x)
                gone, alive = [d for d in alive if d[1] & bit], [d for d in alive if not d[1] & bit]
                fails = sum(bool(m & bit) for _, q, m in docs if q == p)
                want[p, "".join(o), s + 1] = [len(alive), len(gone), fails - len(gone), sum(m == bit for _, q, m in docs if q == p),
                                              sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), 0]
    for p in parts:
        for x in FILTERS:
            keys = [k for k in want if k[0] == p and k[1][k[2] - 1] == x]
            for k in keys:
                want[k][6] = sum(want[j][1] for j in keys)
    assert got == {k: tuple(v) for k, v in want.items()} and len(got) == 600 * len(parts)
    con = duckdb.connect()
    con.register("documents", df.toPandas().astype({"doc_id": "Int64"}))
    con.register("labels", lab.toPandas().astype({"doc_id": "Int64"}))
    sql = {r[:3]: r[3:] for r in con.execute(OP12_SQL).fetchall()}
    assert sql == got


def test_empty_tables(spark):
    d, lab = spark.createDataFrame([], "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit(spark, d, lab).collect() == []
    one = audit(spark, spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string"), lab).collect()
    assert len(one) == 600 and {r["part"] for r in one} == {""}
    assert {r["removed"] for r in one if r["filter_order"][r["step"] - 1] == "A"} == {1}
