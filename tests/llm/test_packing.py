import zlib
from collections import defaultdict

import numpy as np

from prepforge.llm import packing as P
from prepforge.llm.common import Encoder


def table(spark):
    r = np.random.default_rng(4)
    rows = [(i, " ".join(r.choice(["alpha", "beta", "x", "y,", "Zebra"], int(r.integers(0, 300)))), "big" if i % 3 else f"s{i % 5}")
            for i in range(300)]
    rows += [(900, None, None), (901, "", "e"), (902, "long text " * 9000, "s1"), (7, "again", "s2"), (7, "again", "s2"), (None, "no id", "s2")]
    return rows, spark.createDataFrame([(*x, "z") for x in rows], "doc_id long, text string, source string, round string")


def test_every_id_lies_in_one_piece(spark):
    rows, df = table(spark)
    got = P.pack(spark, df, with_ids=True).collect()
    tok = Encoder("word_bpe_49k.json").tok
    want = defaultdict(list)
    for d, t, _ in rows:
        want[d].append([*tok.encode(t or "", add_special_tokens=False).ids, 1])
    seqs, docs = defaultdict(list), defaultdict(list)
    for r in got:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append(r)
    for d, w in want.items():
        if len(w) == 1:
            at, ids = 0, []
            for r in sorted(docs[d], key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(w[0])
                at, ids = at + r["length"], ids + list(r["ids"])
            assert ids == w[0]
        else:
            assert sorted(list(r["ids"]) for r in docs[d]) == sorted(w)
    total = sum(len(x) for w in want.values() for x in w)
    assert sorted(seqs) == list(range(-(-total // 2048)))
    for s, p in seqs.items():
        at = 0
        for off, n in sorted(p):
            assert off == at
            at += n
        assert at == 2048 or s == max(seqs) and at == total % 2048
    out = P.sequences(spark, df).collect()
    assert len(out) == len(seqs) and all(len(r["ids"]) == 2048 or bin(len(r["ids"])).count("1") == 1 for r in out)


def loop(rows, gains, length):
    """Deficit round-robin, window by window: (rid, start, window) of every part."""
    queues = defaultdict(list)
    for rid, s, n in rows:
        queues[s] += [(rid, a, min(length, n - a)) for a in range(0, n, length)]
    credit, out, window = dict.fromkeys(queues, 0.0), [], 0
    while any(queues.values()):
        window += 1
        for s in sorted(queues):
            credit[s] += gains[s]
            while queues[s] and queues[s][0][2] <= credit[s] + 1e-9:
                p = queues[s].pop(0)
                credit[s] -= p[2]
                out.append((p[0], p[1], window))
    return out


def test_plan_equals_the_loop_and_keeps_proportions(spark):
    r = np.random.default_rng(1)
    rows = [(i, "abc"[i % 3], int(r.integers(1, 90))) for i in range(700)] + [(9000, "a", 999)]
    rows.sort(key=lambda x: (x[1], x[0]))
    df = spark.createDataFrame([(a, c, b) for a, b, c in rows], "rid long, n long, source string").select("rid", "source", "n")
    w = {"a": 3.0, "b": 2.0, "c": 1.0}
    got = P.plan_pieces(spark, df, w, 32, 600).collect()
    want = loop(rows, {k: 100 * v for k, v in w.items()}, 32)
    size = {i: n for i, _, n in rows}
    stream, at = {}, 0
    for rid, start, _ in want:
        n = min(32, size[rid] - start)
        for x in range(n):
            stream[rid, start + x] = at + x
        at += n
    for g in got:
        for p in g["pieces"]:
            assert stream[g["rid"], p["start"]] == p["sequence_id"] * 32 + p["offset"]
    taken = defaultdict(lambda: defaultdict(int))
    src = {i: s for i, s, _ in rows}
    for rid, start, win in want:
        taken[win][src[rid]] += min(32, size[rid] - start)
    for win in range(1, 10):
        for s in "abc":
            assert abs(sum(taken[x][s] for x in range(1, win + 1)) - 100 * w[s] * win) <= 32


def test_empty(spark):
    assert P.pack(spark, spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
