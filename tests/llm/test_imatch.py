import hashlib
import re

import numpy as np
import pyarrow as pa

from prepforge.llm.imatch import NONE, SHIFTS, SUBSETS, edited, fingerprints, imatch, lexicon, likeness, term_hashes

LEAST, MOST = 50, 4


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return set(re.findall(r"[^\x20\x09-\x0D]+", low))


def slow(text, lex):
    """The fingerprint as its docstring says, term by term."""
    terms = words(text)
    kept = sorted(t for t in terms if t in lex)
    out = f"{len(kept):08x}" + hashlib.md5(" ".join(kept or sorted(terms)).encode()).hexdigest()[:16]
    for j in range(SUBSETS):
        own = [t for t in kept
               if int(hashlib.md5(f"{t}:{j // 4}".encode()).hexdigest()[8 * (j % 4):8 * (j % 4) + 8], 16) < 2 ** (32 - int(SHIFTS[j]))]
        out += hashlib.md5(" ".join(own).encode()).hexdigest()[:8] if own else NONE
    return out


def slow_near(a, b):
    if a == b:
        return 1.0
    n, x, y = max(int(a[:8], 16), int(b[:8], 16)), a[24:], b[24:]
    pairs = [(x[8 * j:8 * j + 8], y[8 * j:8 * j + 8]) for j in range(SUBSETS) if n < 2 * 2 ** int(SHIFTS[j]) or SHIFTS[j] == SHIFTS.max()]
    pairs = [p for p in pairs if p != (NONE, NONE)]
    return sum(p[0] == p[1] for p in pairs) / max(len(pairs), 1)


def rows():
    r = np.random.default_rng(5)
    vocab = [f"Wörd{i}" for i in range(300)] + ["é", "X", "x", "a&b"]
    out = [(None, "no id at all"), (None, "no id at all"), (7, None), (8, ""), (9, "  \t"), (3, "the SAME row"), (3, "the SAME row"), (3, "another row"), (-4, "x")]
    out += [(100 + i, " ".join(r.choice(vocab, int(r.integers(1, 200))))) for i in range(120)]
    out += [(300 + i, out[20][1]) for i in range(30)] + [(400, " ".join(r.choice(vocab, 30000)))]
    return out


def test_equals_brute_force(spark):
    data = rows()
    df = spark.createDataFrame([(i, t, "q", 1) for i, t in data], "doc_id long, text string, part string, h int").repartition(7)
    got = imatch(spark, df, LEAST, MOST).collect()
    freq = {}
    for _, t in data:
        for w in words(t):
            freq[w] = freq.get(w, 0) + 1
    lex = {w for w, n in freq.items() if n * LEAST >= len(data) and n * MOST <= len(data)}
    assert 0 < len(lex) < len(freq)
    assert lexicon(spark, df, LEAST, MOST).tolist() == sorted(term_hashes(pa.array(sorted(lex))).tolist())
    assert len(got) == len(data)
    # ties on doc_id go by a hash of the text, so follow the order that was taken
    follows = {}
    for r in got:
        follows.setdefault((r["doc_id"], r["n_chars"]), []).append(r)
    texts = {}
    for i, t in data:
        texts.setdefault(i, []).append(t or "")
    fp = {t: slow(t, lex) for t in {t or "" for _, t in data}}
    for r in got:
        own = [t for t in texts[r["doc_id"]] if fp[t] == r["fingerprint"] and len(t) == r["n_chars"]][0]
        nxt = [t for t in texts[r["next_doc_id"]] if hashlib.sha256(edited(own, t).encode()).hexdigest() == r["edited_sha256"]
               and slow_near(fp[own], fp[t]) == r["near_next"]]
        assert nxt
        e = slow(edited(own, nxt[0]), lex)
        assert r["edited_fingerprint"] == e and r["near_edited"] == slow_near(fp[own], e)
    ids = sorted({r["doc_id"] for r in got if r["doc_id"] is not None})
    step = dict(zip(ids, ids[1:]))
    once = [i for i in ids if len(texts[i]) == 1]
    for r in got:
        if r["doc_id"] in once and r["doc_id"] != ids[-1]:
            assert r["next_doc_id"] == step[r["doc_id"]]
    assert {r["next_doc_id"] for r in got if r["doc_id"] is None} == {None, ids[0]}


def test_order_of_partitions_does_not_matter(spark):
    df = spark.createDataFrame([(i, f"text {i} {i % 7}") for i in range(200)], "doc_id long, text string")
    a = {tuple(r) for r in imatch(spark, df.repartition(1)).collect()}
    assert a == {tuple(r) for r in imatch(spark, df.repartition(13)).collect()} and len(a) == 200


def test_small_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert imatch(spark, empty).collect() == []
    one, = imatch(spark, spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).collect()
    assert (one["next_doc_id"], one["near_next"], one["n_chars"]) == (5, 1.0, 4)
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    none = imatch(spark, spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert [r["near_next"] for r in none] == [1.0, 1.0]


def test_likeness_follows_the_overlap():
    lex = np.sort(term_hashes(pa.array([f"t{i}" for i in range(5000)])))
    r = np.random.default_rng(2)
    est = []
    for share in (0.0, 0.5, 0.9):
        a, b = [], []
        for _ in range(60):
            t = r.permutation(5000)[:600]
            k = int(300 * share)
            a.append(" ".join(f"t{i}" for i in t[:300]))
            b.append(" ".join(f"t{i}" for i in [*t[:k], *t[300:600 - k]]))
        est.append(likeness(fingerprints(pa.array(a), lex), fingerprints(pa.array(b), lex)).mean())
    assert est[0] < 0.01 and 0.2 < est[1] < 0.45 and 0.6 < est[2] < 0.95
