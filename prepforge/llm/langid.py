"""Operator 4: languages of mixed texts. Script ranges narrow the candidates of each word, hashed
word and character n-gram counts score them, and Viterbi with a switching penalty labels spans."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepforge.llm.common import crc_mod, documents, numbers, prepare, strings, texts_of

#: First code points of script ranges (Unicode block bounds) and the script that begins there.
SCRIPTS = [(0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "other"), (0x0E00, "thai"),
           (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
           (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
           (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other")]
_FIRST = [a for a, _ in SCRIPTS]
NAMES = sorted({s for _, s in SCRIPTS})
#: Buckets of hashed features, of which each language has one count.
D = 1 << 18
CHUNK = 1 << 12
#: A language is a candidate in a script that holds at least this share of its words.
SCRIPT_SHARE = 0.005
#: Bounds of a word's evidence, and the cost of changing language between two words (nats).
FLOOR, BARRED, SWITCH = 5.0, 15.0, 9.0


def script(word: str) -> int:
    i = bisect.bisect_right(_FIRST, ord(word[0])) - 1
    return NAMES.index(SCRIPTS[i][1]) if i >= 0 else NAMES.index("other")


#: Odd multipliers of the hashes.
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MULT[1]
    return (h >> np.uint64(40)).astype(np.int64) % D


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each whole word, buckets of all words' 2- to 4-grams, the words they are of);
    a word's edges are marked."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    cp = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = np.fromiter(map(len, words), np.int64, len(words)) + 2
    start = np.cumsum(n) - n
    word = np.repeat(np.arange(len(words)), n)
    pos = np.arange(len(cp))
    left = (start + n)[word] - pos  # characters up to the word's end
    power = np.cumprod(np.full(int(n.max()), _MULT[0]))
    whole = _bucket(np.add.reduceat(cp * power[pos - start[word]], start) + np.uint64(1))
    out, of = [], []
    for k in (2, 3, 4):
        i = pos[left >= k]
        h = np.full(len(i), k, np.uint64)
        for j in range(k):
            h = (h + cp[i + j]) * _MULT[j]
            h ^= h >> np.uint64(29)
        out.append(_bucket(h))
        of.append(word[i])
    return whole, np.concatenate(out), np.concatenate(of)


def letter_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased runs of letters and marks (64 code points at most in one) and texts' offsets."""
    low = pc.utf8_lower(pc.replace_substring_regex(texts, r"[^\p{L}\p{M}]+", " "))
    # a run too long to be a word is cut into several; no letter is lost
    low = pc.replace_substring_regex(low, r"([^ ]{64})", r"\1 ")
    parts = pc.split_pattern(low, " ")
    flat = parts.flatten()
    full = pc.match_substring_regex(flat, r"\p{L}")
    keep = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))]).astype(np.int64)
    off = parts.offsets.to_numpy().astype(np.int64)
    return flat.filter(full), keep[off - off[0]]


def learn(spark: SparkSession, docs: DataFrame) -> dict:
    """Counts of features and scripts by language from all rows (text, lang), lang not null.

    Each task adds its words up and sends dense pieces of its counts, which are summed by piece;
    the driver gets ``D`` counts a language, whatever the input."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, int] = {}
        slots: dict[str, int] = {}
        counts = np.zeros((0, 0), np.int64)
        total: dict[str, np.ndarray] = {}
        kinds: dict[str, np.ndarray] = {}

        def flush():
            if not slots:
                return
            whole, grams, of = features(list(slots))
            flat, row = np.concatenate([whole, grams]), np.concatenate([np.arange(len(whole)), of])
            s = np.array([script(w) for w in slots])
            for lang, j in langs.items():
                c = counts[:len(slots), j]
                total.setdefault(lang, np.zeros(D, np.int64))
                total[lang] += np.bincount(flat, c[row], D).astype(np.int64)
                kinds.setdefault(lang, np.zeros(len(NAMES), np.int64))
                kinds[lang] += np.bincount(s, c, len(NAMES)).astype(np.int64)

        for b in batches:
            words, off = letter_words(texts_of(b.column(0)))
            d = words.dictionary_encode()
            names = strings(d.dictionary)
            if len(slots) > 300_000:
                flush()
                slots, counts = {}, np.zeros((0, 0), np.int64)
            for lang in b.column(1).to_pylist():
                langs.setdefault(lang, len(langs))
            for w in names:
                slots.setdefault(w, len(slots))
            grown = np.zeros((max(len(slots), 2 * len(counts)) if len(slots) > len(counts) else len(counts), len(langs)), np.int64)
            grown[:counts.shape[0], :counts.shape[1]] = counts
            counts = grown
            if names:
                at = numbers(slots, names)[d.indices.to_numpy()]
                who = np.repeat([langs[x] for x in b.column(1).to_pylist()], np.diff(off))
                counts += np.bincount(at * len(langs) + who, minlength=counts.size).reshape(counts.shape)
        flush()
        for lang, t in total.items():
            pieces = [(-1, kinds[lang])] + [(i, t[i * CHUNK:(i + 1) * CHUNK]) for i in range(D // CHUNK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(pieces)), pa.array([i for i, _ in pieces], pa.int32()),
                 pa.array([zlib.compress(p.astype("<i8").tobytes(), 1) for _, p in pieces], pa.binary())],
                names=["lang", "chunk", "counts"])

    def add(pdf):
        import pandas as pd
        s = sum(np.frombuffer(zlib.decompress(x), "<i8") for x in pdf["counts"])
        return pd.DataFrame({"lang": [pdf["lang"][0]], "chunk": [pdf["chunk"][0]], "counts": [zlib.compress(s.tobytes())]})

    schema = "lang string, chunk int, counts binary"
    rows = docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).where("lang is not null").mapInArrow(
        count, schema).groupBy("lang", "chunk").applyInPandas(add, schema).collect()
    langs = sorted({r["lang"] for r in rows})
    table, kinds = np.zeros((D, len(langs))), np.zeros((len(NAMES), len(langs)))
    for r in rows:
        c, j = np.frombuffer(zlib.decompress(r["counts"]), "<i8"), langs.index(r["lang"])
        if r["chunk"] < 0:
            kinds[:, j] = c
        else:
            table[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK, j] = c
    n = table.sum(axis=0, keepdims=True)
    logp = np.log((table + 0.5) / (n + 0.5 * D)).astype(np.float32)
    return {"langs": langs, "logp": logp, "candidate": kinds >= SCRIPT_SHARE * np.maximum(kinds.sum(axis=0, keepdims=True), 1)}


class Scorer:
    """Scores of distinct words under each language: 0 for the best, at least -FLOOR for other
    candidates of the word's script and -BARRED for the rest; all 0 if no language uses the script."""

    def __init__(self, model: dict, limit: int = 400_000):
        self.model, self.limit = model, limit
        self.slots: dict[str, int] = {}
        self.scores = np.zeros((0, len(model["langs"])), np.float32)

    def of(self, words: pa.Array) -> np.ndarray:
        d = words.dictionary_encode()
        names = strings(d.dictionary)
        if len(self.slots) > self.limit:
            self.slots, self.scores = {}, self.scores[:0]
        slot = numbers(self.slots, names)
        new = [names[i] for i in np.flatnonzero(slot < 0)]
        for s in range(0, len(new), 20_000):
            part = new[s:s + 20_000]
            whole, grams, of = features(part)
            lp = self.model["logp"]
            raw = lp[whole] + 0.5 * np.stack([np.bincount(of, lp[grams, j], len(part)) for j in range(lp.shape[1])], axis=1)
            ok = self.model["candidate"][[script(w) for w in part]]
            none = ~ok.any(axis=1)
            raw = np.where(ok, raw, -np.inf)
            raw[none] = 0
            raw = np.maximum(raw - raw.max(axis=1, keepdims=True), -FLOOR)
            raw = np.where(ok | none[:, None], raw, -BARRED).astype(np.float32)
            for w in part:
                self.slots[w] = len(self.slots)
            self.scores = np.concatenate([self.scores, raw])
        if not names:
            return np.zeros((0, self.scores.shape[1]), np.float32)
        if new:
            slot = numbers(self.slots, names)
        return self.scores[slot[d.indices.to_numpy()]]


def viterbi(e: np.ndarray, off: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of each word when a change between neighbours costs ``switch``; all texts
    step forward together, the longest first, so that those still running are a prefix."""
    n, k = np.diff(off), e.shape[1]
    out = np.zeros(len(e), np.int64)
    if not len(e):
        return out
    order = np.argsort(-n, kind="stable")
    start, lens = off[:-1][order], n[order]
    running = np.searchsorted(-lens, -np.arange(lens[0]), side="left")  # texts longer than t
    # a word's tag comes from the same language or, by a change, from the one best language of the
    # word before: a flag each and one number a word, whatever the number of languages
    stays, source = np.empty((len(e), k), bool), np.empty(len(e), np.int64)
    score = np.zeros((len(n), k))
    score[:running[0]] = e[start[:running[0]]]
    for t in range(1, lens[0]):
        r = running[t]
        prev, at = score[:r], start[:r] + t
        best = prev.argmax(axis=1)
        jump = prev[np.arange(r), best] - switch
        stay = prev >= jump[:, None]
        stays[at], source[at] = stay, best
        score[:r] = np.where(stay, prev, jump[:, None]) + e[at]
    state = score.argmax(axis=1)
    for t in range(lens[0] - 1, -1, -1):
        r = running[t]
        at = start[:r] + t
        out[at] = state[:r]
        if t:
            state[:r] = np.where(stays[at, state[:r]], state[:r], source[at])
    return out


def label_texts(texts: pa.Array, scorer: Scorer) -> list[tuple[str, float, str]]:
    """(language, share of the words in its spans, spans ``lang:first word:end``) of each text."""
    langs = scorer.model["langs"]
    words, off = letter_words(texts)
    n = np.diff(off)
    if not langs:
        return [("und", 0.0, "")] * len(n)
    e = scorer.of(words)
    tags = viterbi(e, off)
    doc = np.repeat(np.arange(len(n)), n)
    share = np.bincount(doc * len(langs) + tags, minlength=len(n) * len(langs)).reshape(len(n), -1).astype(float)
    total = np.stack([np.bincount(doc, e[:, j], len(n)) for j in range(len(langs))], axis=1)
    # most words; on a tie the better score, then the first name
    pick = np.lexsort((-np.arange(len(langs))[None, :].repeat(len(n), 0), total, share), axis=1)[:, -1]
    edge = np.flatnonzero(np.concatenate([[True], (tags[1:] != tags[:-1]) | (doc[1:] != doc[:-1])])) if len(tags) else []
    spans: list[list[str]] = [[] for _ in range(len(n))]
    for s, t in zip(edge, [*edge[1:], len(tags)]):
        i = doc[s]
        spans[i].append(f"{langs[tags[s]]}:{s - off[i]}:{t - off[i]}")
    return [("und", 0.0, "") if not n[i] else (langs[pick[i]], float(share[i, pick[i]] / n[i]), ",".join(spans[i]))
            for i in range(len(n))]


_SCORERS: dict[int, Scorer] = {}


def scorer_of(key: int, shared) -> Scorer:
    """One per Python worker and model, kept between tasks."""
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(shared.value)
    return _SCORERS[key]


def identify(spark: SparkSession, docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score, spans of every row of ``docs``, from the whole text alone.

    ``und`` with score 0 and no spans if the text is null or has no letter, or if nothing was
    learned. Repeated rows and null ids are returned as they come; other columns are not looked
    at; an empty table gives no rows. The model is sent to the executors: ``D`` numbers a language.
    """
    prepare(spark)
    shared, key = spark.sparkContext.broadcast(model), zlib.crc32(model["logp"].tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = label_texts(texts_of(b.column(1)), scorer_of(key, shared))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()),
                 pa.array([r[2] for r in rows], pa.string())], names=["doc_id", "lang_pred", "score", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, spans string")


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    model = learn(spark, docs.where(crc_mod("doc_id", 5) != 0).select("text", "lang"))
    return identify(spark, docs, model).select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "spans")
