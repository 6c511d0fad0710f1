import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pytest

from prepforge.llm import token_files as S
from prepforge.llm.common import Encoder

ODD = [None, "", "   ", "Hello, World's 'tis don't we'll x'y", "naïve Élan ß İ ſ K", "a b c　d", "12345 6.7",
       "<|endoftext|> a<|startoftext|>b <|STARTOFTEXT|>", "é ́x a ́", "日本語 текст ελληνικά", "🙂🙃 :-) ...!!!",
       "x" * 3000, "tab\tnew\nline\x0bvt\x0cff\rcr", "\x1c\x1d\x85 odd spaces", "'S 'T it'S", "\x00 nul", "a\x01b \x01 ,\x01. c", "The. the, THE! the?! İx. ΟΔΟΣ οδος Éa, éA; ...", "word.word, ,word x:y: z;;"]


def whole(tok, text, end):
    return [*tok.encode(text or "", add_special_tokens=False).ids, end]


def test_word_by_word_ids_equal_whole_texts():
    enc = Encoder("word_bpe_49k.json", limit=50)
    r = np.random.default_rng(2)
    alphabet = list("abcdeéßΩ'.,!0123 \t\n ́<|>🙂AB")
    texts = ODD + ["".join(r.choice(alphabet, int(n))) for n in r.integers(0, 80, 400)]
    for s in range(0, len(texts), 40):
        part = texts[s:s + 40]
        ids, off = enc.ids(pa.array([t or "" for t in part]), 7)
        for i, t in enumerate(part):
            assert ids[off[i]:off[i + 1]].tolist() == whole(enc.tok, t, 7), t


@pytest.mark.parametrize("n", [0, 1, 2, 1023, 1024, 1025, 5000])
@pytest.mark.parametrize("top", [1, 2, 60000, 1 << 35, (1 << 60) - 1, (1 << 64) - 1])
def test_round_trip(n, top):
    r = np.random.default_rng(n)
    for ids in (r.integers(0, top, n, dtype=np.uint64, endpoint=True), np.zeros(n, np.uint64), np.full(n, top, np.uint64),
                np.where(r.random(n) < .9, 0, r.integers(0, top, n, dtype=np.uint64, endpoint=True)).astype(np.uint64)):
        words, offsets = S.encode(ids)
        assert (S.decode(words, offsets, n) == ids).all()


def test_words_hold_what_their_selectors_say():
    words, _ = S.encode(np.full(600, 1000, np.uint64))
    assert (words[:-1] >> np.uint64(60) == 10).all() and len(words) == 100


def test_files(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_IDS", 500)
    rows = [(i * 7 % 101, t) for i, t in enumerate(ODD * 3)] + [(500, "a b c " * 3000), (-3, "first"), (None, "none"), (9, "twice"), (9, "twice")]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, part string")
    path = tempfile.mkdtemp(prefix="run-") + "/t"
    S.write_token_files(spark, df, path)
    got = sorted(S.read_token_files(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    tok = Encoder("word_bpe_49k.json").tok
    at, order = 0, [-10 ** 9 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert order == sorted(order) and len(got) == len(rows)
    want = {}
    for d, t in rows:
        want.setdefault(d, []).append(whole(tok, t, 2))
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        want[r["doc_id"]].remove(list(r["ids"]))
        at += r["n_tokens"]


def test_empty(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/t"
    S.write_token_files(spark, spark.createDataFrame([], "doc_id long, text string"), path)
    assert S.read_token_files(spark, path).count() == 0
