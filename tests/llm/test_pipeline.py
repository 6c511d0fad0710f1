"""run() against a version of stages 2, 4 and 5 in plain Python and the trained stages' own models."""
import math
import tempfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

import corpus_pipeline
from prepforge.llm import quality, secrets
from prepforge.llm.common import Encoder
from tests.llm.test_mixing import loop_targets
from tests.llm.test_simhash import slow

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def folder(spark, rows):
    d = tempfile.mkdtemp(prefix="run-")
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i % 7 > 0), 0) for i in range(0, 200, 2)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{d}/labels.parquet")
    return d


def corpus():
    r = np.random.default_rng(12)
    words = ["river", "House", "of", "the", "stone,", "green.", "walk", "day", "night", "over", "small", "été"] + \
        [f"{a}{b}{c}" for a in ("ba", "co", "du") for b in ("rin", "lat", "mon") for c in "xyz"]
    rows = []
    for i in range(200):
        w = [str(x) for x in r.choice(words, int(r.integers(30, 90)))]
        if i % 7 == 0:
            w = [x + "###" for x in w]
        if i % 11 == 1:
            w += ["token", "=", '"' + "".join(r.choice(list("0123456789abcdef"), 40)) + '"', "the", "end"]
        t = " ".join(w)
        rows.append((i, t, "en", f"s{i % 3}" if i % 13 else None, len(t)))
    rows += [(300 + i, rows[i + 1][1], "en", "s1", rows[i + 1][4]) for i in range(5)]
    rows += [(rows[4][0], *rows[4][1:])] * 2 + [(400, None, None, "s0", None), (401, "", "en", "s0", 0)]
    return rows


def test_run_equals_brute_force(spark):
    rows = corpus()
    d = folder(spark, rows)
    df = spark.read.parquet(f"{d}/documents.parquet")
    got = corpus_pipeline.run(spark, d).collect()
    # 1
    w, _ = quality.fit(spark, df, spark.read.parquet(f"{d}/labels.parquet"))
    ok = quality.scores(pa.array([r[1] or "" for r in rows]), w) >= 0.5
    kept = [r for r, k in zip(rows, ok) if k]
    assert all(i % 7 for i, *_ in kept if i < 200) and len(kept) > 150
    # 2
    fp = {r[0]: slow(r[1]) for r in kept}
    comp = {i: i for i in fp}
    changed = True
    while changed:
        changed = False
        for a in fp:
            for b in fp:
                if bin(fp[a] ^ fp[b]).count("1") <= 2 and comp[a] > comp[b]:
                    comp[a], changed = comp[b], True
    kept = {r[0]: r for r in kept if comp[r[0]] == r[0]}
    # 3
    model = secrets.fit(spark, spark.createDataFrame(list(kept.values()), COLUMNS))
    spans = secrets.scan_texts(pa.array([r[1] for r in kept.values()]), secrets.Words(model[0]), model[1])
    texts, held = {}, 0
    for (i, r), s in zip(kept.items(), spans):
        t, last = "", 0
        marks = sorted((a, b) for a, _, b in s)
        for a, b in marks:
            if a >= last:
                t += r[1][last:a] + "<redacted>"
            last = max(last, b)
        texts[i] = t + r[1][last:]
        held += bool(marks)
    assert held >= 10
    # 4
    size = {i: len(t.split()) for i, t in texts.items()}
    total = defaultdict(int)
    for i in texts:
        total[kept[i][3]] += size[i]
    target, copies = loop_targets(dict(total)), Counter()
    import hashlib
    for s in total:
        u = int(hashlib.md5((s if s is not None else "(null)").encode()).hexdigest()[:8], 16) / 2 ** 32
        rate = target[s] / total[s]
        for k, i in enumerate(sorted((i for i in texts if kept[i][3] == s), key=lambda i: (size[i], i))):
            copies[i] = math.floor((k + 1) * rate + u) - math.floor(k * rate + u)
    # 5
    tok = Encoder("word_bpe_49k.json").tok
    ids = {i: [*tok.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    assert {r["doc_id"] for r in got} == {i for i in texts if copies[i]}
    by, seqs = defaultdict(int), defaultdict(int)
    for r in got:
        own = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(own) == r["length"] and zlib.crc32(np.array(own, "<u4").tobytes()) == r["ids_crc32"]
        by[r["doc_id"]] += r["length"]
        seqs[r["sequence_id"]] += r["length"]
    assert all(by[i] == copies[i] * len(ids[i]) for i in by)
    assert all(n == 2048 for s, n in seqs.items() if s != max(seqs))


def test_stages_return_the_columns_of_documents(spark):
    d = folder(spark, corpus())
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns


def test_empty(spark):
    d = folder(spark, [])
    assert corpus_pipeline.run(spark, d).count() == 0


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "simhash near-dedup", "secret scans", "mixing", "packing"]
