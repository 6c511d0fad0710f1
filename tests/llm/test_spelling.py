import re
from zlib import crc32

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from prepforge.llm.spelling import branches, near_pairs, spelling_variants


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow(rows):
    count = {}
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                count[run] = count.get(run, 0) + 1
    words = {w: n for w, n in count.items() if n >= 2}
    out = {}
    for w, n in words.items():
        others = [v for v in words if v != w and near(v, w)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= 10 * n else None
        out[w] = [n, len(others), form, words[form] if form else None]
    for w in out:
        root = w
        while out[root][2]:
            root = out[root][2]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def table(spark, rows):
    return spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, n int, word string")


def result(spark, rows):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling_variants(spark, table(spark, rows).repartition(5)).collect()}


def test_equals_brute_force(spark):
    r = np.random.default_rng(6)
    letters = list("abcdeéß")
    base = ["".join(r.choice(letters, int(n))) for n in r.integers(7, 12, 40)]
    base += ["a" * 7, "a" * 8, "a" * 9, "x" * 300, "x" * 299 + "y", "abababab", "babababa", "abcdefg", "abcdefgh", "zabcdefg"]
    rows = [(None, None), (1, ""), (2, "short ones x÷y ×Àé"), (3, "UPPERCASE uppercase ÉTÉÉÉÉÉÉ étéééééé"), (None, "nullidword nullidword"), (7, "a1b2" * 3)]
    for i in range(400):
        pick = r.choice(len(base), 6, p=None)
        out = []
        for k in pick:
            w = base[int(k)]
            at = int(r.integers(0, len(w)))
            kind = int(r.integers(0, 8))
            c = str(r.choice(letters))
            out.append({0: w[:at] + w[at + 1:], 1: w[:at] + c + w[at + 1:], 2: w[:at] + c + w[at:]}.get(kind, w))
        rows.append((10 + i, (",", " ", "　", "3")[i % 4].join(out)))
    rows += [(1000 + i, "commonword " * 20) for i in range(60)] + [(2000, "commonward " * 100), (2001, "commonwurd " * 9 + "commonwards " * 4)]
    want = slow(rows)
    assert result(spark, rows) == want
    assert any(v[4] != (v[2] or w) for w, v in want.items())  # a chain of two forms


def test_hot_prefix_and_suffix(spark):
    """A third of the words share their first half, a third the second."""
    r = np.random.default_rng(8)
    tail = ["".join(r.choice(list("abc"), 5)) for _ in range(150)]
    rows = [(None, " ".join(f"shared{t} {t}common plain{i}x" for i, t in enumerate(tail)))] * 2
    assert result(spark, rows) == slow(rows)


def test_small_tables(spark):
    assert spelling_variants(spark, table(spark, [])).collect() == []
    assert result(spark, [(1, None), (2, "one two")]) == {}
    got = result(spark, [(None, "singleword singleword")])
    assert got == slow([(None, "singleword singleword")]) and len(got) == 1


def test_pairs_at_any_number_of_ranges(spark):
    words = sorted({"".join("abc"[(i >> s) % 3] for s in range(0, 14, 2)) + "z" * (i % 3) for i in range(600)})
    want = {(a, b) for a in words for b in words if a != b and near(a, b)}
    n = spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.createDataFrame([(w,) for w in words], "word string")
    try:
        for parts in ("1", "23"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = [tuple(r) for r in near_pairs(spark, df).collect()]
            assert len(got) == len(set(got)) and set(got) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", n)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=4, max_size=9), min_size=2, max_size=40, unique=True), st.integers(1, 39))
def test_ranges_agree_on_branching_nodes(words, cut):
    words = sorted(words)
    cut = min(cut, len(words) - 1)
    whole = branches(words, "", "", 2)
    split = branches(words[:cut], "", words[cut], 2) + branches(words[cut:], words[cut - 1], "", 2)
    for w, a, b in zip(words, whole, split):
        real = [d for d in range(2, len(w) + 1) if len({v[d:d + 1] for v in words if v[:d] == w[:d]}) > 1]
        assert a == real
        assert set(a) <= set(b) and all(words[cut - 1][:d] == w[:d] == words[cut][:d] for d in set(b) - set(a))
