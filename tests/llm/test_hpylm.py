import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from prepforge.llm import hpylm as H
from prepforge.llm.common import crc_mod


def split(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]


def corpus():
    r = np.random.default_rng(9)
    after = {w: list(r.choice([f"{w}{x}" for x in "abcdefgh"] + ["the", "of"], 4)) for w in ("the", "of", "Éa", "to")}
    rows = []
    for i in range(400):
        t, w = [], "the"
        for _ in range(int(r.integers(0, 40))):
            w = str(r.choice(after[w])) if w in after and r.random() < .8 else str(r.choice(["the", "of", "Éa", "to", f"w{r.integers(0, 60)}"]))
            t.append(w.upper() if r.random() < .05 and w.isascii() else w)
        rows.append((i, " ".join(t)))
    return rows + [(1000, None), (1001, ""), (1002, "the " * 6000), (None, "the of"), (7, rows[7][1]), (7, rows[7][1])]


def frame(spark, rows):
    df = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, score string")
    return df.withColumn("held_out", crc_mod("doc_id", 5) == 1)


def test_counts_equal_brute_force_and_score_beats_base(spark):
    rows = corpus()
    got = H.score_texts(spark, frame(spark, rows)).collect()
    assert len(got) == len(rows)
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    c = Counter(w for d, t in rows if not held(d) for w in split(t))
    n, v = sum(c.values()), len(c)
    texts = {d: t for d, t in rows}
    for r in got:
        w = split(texts[r["doc_id"]])
        assert r["held_out"] == held(r["doc_id"]) and r["n_tokens"] == len(w) and r["train_tokens"] == n
        assert r["n_known"] == sum(c[x] > 0 for x in w)
        assert math.isclose(r["base_score"], sum(math.log10((c[x] + .5) / (n + .5 * (v + 1))) for x in w), rel_tol=1e-9)
        assert r["score"] < 0
    held_rows = [r for r in got if r["held_out"]]
    per = lambda k: sum(r[k] for r in held_rows) / sum(r["n_tokens"] for r in held_rows)
    assert per("score") > per("base_score") + 0.05
    again = H.score_texts(spark, frame(spark, rows).repartition(5)).collect()
    key = lambda r: (r["doc_id"] or -1, r["n_tokens"])
    for a, b in zip(sorted(got, key=key), sorted(again, key=key)):
        assert math.isclose(a["score"], b["score"], rel_tol=1e-5)


def test_probabilities_sum_to_one(monkeypatch):
    """All words after one context, the unseen one included, over several buckets."""
    texts = pa.array([t or "" for _, t in corpus()])
    h, ctx, doc = H.tokens(texts)
    hot = np.sort(np.array([H.word_hash(b"the")], np.uint64))
    payloads = list(H.unit_payloads(h, ctx, doc, len(texts), len(texts), 3, hot))
    buckets = [(b, H.merge([(0, p)], hot)[0]) for b, p in payloads]

    def summed(model, states):
        total = {}
        for b, data in buckets:
            own = H.Bucket(b, data, model)
            for seating in own.sweeps(states):
                pass
            for k, v in own.totals(seating):
                total[k] = total.get(k, 0) + v
        return total

    monkeypatch.setattr(H, "summed", lambda spark, table, model, states: summed(model, states))
    model, states = H.fit(None, None, 1)
    assert model["train_tokens"] == len(h) and model["types"] == len(np.unique(h))
    for context in np.unique(ctx)[:6].tolist():
        cu = model["by_context"][context]
        mass = np.zeros(H.SWEEPS - H.BURN)
        parents = np.zeros(H.SWEEPS - H.BURN)
        for b, data in buckets:
            own = H.Bucket(b, data, model)
            for s, (t, customers, tables) in enumerate(own.sweeps(states[:-1])):
                if s <= H.BURN:
                    continue
                p0 = own.parent(customers, tables, states[s])
                at = own.ctx == context
                first = np.concatenate([[True], own.dish[1:] != own.dish[:-1]])
                whole = ~own.hot | (b == 0)  # a frequent word is in every bucket
                parents[s - H.BURN - 1] += p0[whole].sum()
                mass[s - H.BURN - 1] += (own.c[at] - model["d1"] * t[at]).sum() / (H.THETA + cu)
                assert first.sum() == own.n
        for s in range(H.BURN + 1, H.SWEEPS + 1):
            i = s - H.BURN - 1
            unseen = (H.THETA_0 + model["d0"] * states[s]["tables"]) / (model["types"] + 1) / (H.THETA_0 + states[s]["customers"])
            assert math.isclose(parents[i] + unseen, 1, rel_tol=1e-9)
            back = (H.THETA + model["d1"] * states[s]["by_context"][context]) / (H.THETA + cu)
            assert math.isclose(mass[i] + back, 1, rel_tol=1e-9)


def test_seating_follows_the_restaurant():
    c = np.array([1, 2, 5, 30, 200] * 4000)
    got = H.seat(c, np.full(len(c), 2.0), 0.6, np.random.default_rng(0)).reshape(-1, 5)
    r = np.random.default_rng(1)
    for j, n in enumerate((1, 2, 5, 30, 200)):
        want = []
        for _ in range(1500):
            t = 1
            for k in range(1, n):
                t += r.random() < 2.0 / (2.0 + k - .6 * t)
            want.append(t)
        assert abs(got[:, j].mean() - np.mean(want)) < 0.06 * np.mean(want) + 1e-9


def test_pack():
    a = [np.array([1, 300, 70000]), np.array([], np.int64), np.array([1.5]), np.array([2 ** 63], np.uint64)]
    assert all((x == y).all() for x, y in zip(a, H.unpack(H.pack(*a))))


def test_nothing_to_learn_and_empty(spark):
    df = spark.createDataFrame([(1, "a b", True), (2, None, True)], "doc_id long, text string, held_out boolean")
    got = {r["doc_id"]: r for r in H.score_texts(spark, df).collect()}
    assert got[1]["n_tokens"] == 3 and got[2]["n_tokens"] == 1 and got[1]["score"] == got[1]["base_score"] == 0
    assert H.score_texts(spark, df.limit(0)).count() == 0
