import itertools

import numpy as np
import pyarrow as pa

from prepforge.llm import langid as L

EN = "the house of my father stands near the river and we walk there every evening with the dog".split()
DE = "das haus meines vaters steht nahe dem fluss und wir gehen dort jeden abend mit dem hund spazieren".split()
RU = "дом моего отца стоит у реки и мы гуляем там каждый вечер с собакой".split()


def corpus():
    r = np.random.default_rng(0)
    rows = []
    for i in range(240):
        lang, words = [("en", EN), ("de", DE), ("ru", RU)][i % 3]
        rows.append((i, " ".join(r.choice(words, int(r.integers(3, 50)))) + ", 42!", lang))
    return rows


def test_viterbi_equals_all_paths():
    r = np.random.default_rng(1)
    lens = [4, 0, 1, 6, 3]
    off = np.concatenate([[0], np.cumsum(lens)])
    e = r.normal(0, 3, (off[-1], 3))
    got = L.viterbi(e, off, 2.0)
    for a, b in zip(off, off[1:]):
        best = max(itertools.product(range(3), repeat=b - a),
                   key=lambda p: sum(e[a + i, s] for i, s in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:])))
        assert got[a:b].tolist() == list(best)


def test_held_out_accuracy_and_spans(spark):
    rows = corpus()
    df = spark.createDataFrame([(*x, "z") for x in rows], "doc_id long, text string, lang string, spans string")
    model = L.learn(spark, df.where("doc_id % 5 <> 0"))
    assert model["langs"] == ["de", "en", "ru"]
    got = {r["doc_id"]: r for r in L.identify(spark, df, model).collect()}
    assert sum(got[i]["lang_pred"] == lang for i, _, lang in rows) >= 0.99 * len(rows)
    odd = [(1, None), (2, ""), (3, "123 -- 456"), (4, " ".join(EN + DE)), (5, " ".join(DE * 2000)), (6, "日本語"), (7, "x" * 500),
           (8, "собакой house the father"), (None, "the house"), (9, "the"), (9, "the")]
    out = L.identify(spark, spark.createDataFrame(odd, "doc_id long, text string"), model).collect()
    assert len(out) == len(odd)
    by = {r["doc_id"]: r for r in out}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3))
    assert all(0 <= r["score"] <= 1 for r in out)
    spans = by[4]["spans"].split(",")
    assert [s.split(":")[0] for s in spans] == ["en", "de"] and abs(int(spans[0].split(":")[2]) - len(EN)) <= 2
    assert by[5]["lang_pred"] == "de" and by[5]["score"] == 1.0
    assert by[8]["spans"].startswith("ru:0:1")


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = L.learn(spark, df)
    assert [r["lang_pred"] for r in L.identify(spark, df, model).collect()] == ["und"]
    assert L.identify(spark, df.limit(0), model).count() == 0


def test_words_are_whole():
    w, off = L.letter_words(pa.array(["Été 12 l'eau", "", "y" * 150]))
    assert w.to_pylist()[:3] == ["été", "l", "eau"] and sum(len(x) for x in w.to_pylist()[3:]) == 150 and off.tolist()[:3] == [0, 3, 3]


def test_two_hundred_languages():
    r = np.random.default_rng(5)
    off = np.array([0, 40, 40, 100, 103])
    want = np.concatenate([np.repeat([199, 3], 20), np.repeat([128, 127, 150], 20), [180] * 3])
    e = r.normal(0, 1, (103, 200))
    e[np.arange(103), want] += 30
    assert L.viterbi(e, off).tolist() == want.tolist()
    langs = [f"l{i:03d}" for i in range(200)]
    words = ["".join(chr(97 + (i // 26 ** j + 7 * j) % 26) for j in range(6)) for i in range(200)]

    class Known:
        model = {"langs": langs}

        def of(self, flat):
            out = np.full((len(flat), 200), -8.0, np.float32)
            out[np.arange(len(flat)), [words.index(w) for w in flat.to_pylist()]] = 0
            return out

    texts = pa.array([" ".join([words[i]] * 9) for i in range(200)])
    got = L.label_texts(texts, Known())
    assert got == [(langs[i], 1.0, f"{langs[i]}:0:9") for i in range(200)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert L.identify(spark, empty, L.learn(spark, empty.select("text", "lang"))).collect() == []
