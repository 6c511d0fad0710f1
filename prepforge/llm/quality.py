"""Operator 1: a quality classifier from weak labels.

Overlapping heuristics (and a table of labels, where it has the document) each vote good, bad or
not at all. Expectation-maximisation over the counts of all vote patterns estimates how often each
one votes what on good and on bad documents, and so each pattern's posterior. A linear scorer on
hashed features is trained on the posteriors of a bounded sample and scores every whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepforge.llm.common import documents, kept, materialize, numbers, prepare, split_words, strings, texts_of

#: Each heuristic: a share measured on the text, and the shares from which it votes bad and up to
#: which it votes good (the other way round for the share of distinct words).
HEURISTICS = (("marks", 0.10, 0.02), ("capitals", 0.35, 0.10), ("echoes", 0.15, 0.06),
              ("distinct", 0.25, 0.50), ("separators", 0.08, 0.02), ("lines", 0.40, 0.34))
#: Documents of either likely class that the scorer is trained on, at most so many each.
TRAIN_DOCS = 1500
#: Bytes of a text that the scorer may be trained on (what reaches the driver is bounded), words remembered.
TRAIN_BYTES, MEMORY = 1 << 15, 200_000
WORD_BUCKETS, LEVELS = 1 << 12, 16
N_FEATURES = WORD_BUCKETS + LEVELS * len(HEURISTICS)
_MARKS = r"&&|##|\*\*|%%|\$\$|!!|@@|~~|\^\^|\+\+|<<|>>|\|\||\?\?"


def shares(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(shares [texts, heuristics], words of each text, distinct words, their numbers, offsets)."""
    words, off = split_words(texts)
    n = np.diff(off)
    d = words.dictionary_encode()
    names, at = d.dictionary, d.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(n)), n)
    flag = lambda r: pc.match_substring_regex(names, r).to_numpy(zero_copy_only=False)
    upper = flag(r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$")
    per = lambda x: np.bincount(doc[x], minlength=len(n)) / np.maximum(n, 1)
    same = np.concatenate([[False], (at[1:] == at[:-1]) & (doc[1:] == doc[:-1])]) if len(at) else np.zeros(0, bool)
    kinds = np.bincount(np.unique(doc * max(len(names), 1) + at) // max(len(names), 1), minlength=len(n)) / np.maximum(n, 1)
    lines = pc.split_pattern(texts, "\n")
    flat = lines.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    line_doc = np.repeat(np.arange(len(n)), np.diff(lines.offsets.to_numpy()))[full]
    code = flat.dictionary_encode().indices.to_numpy().astype(np.int64)[full]
    m = np.bincount(line_doc, minlength=len(n))
    own = np.bincount(np.unique(line_doc * (len(flat) + 1) + code) // (len(flat) + 1), minlength=len(n))
    out = np.stack([per(flag(_MARKS)[at]), per(upper[at]), per(same), kinds, per(flag(r"^[|•·>»/\\_-]+$")[at]),
                    1 - own / np.maximum(m, 1)], axis=1) if len(names) else np.zeros((len(n), len(HEURISTICS)))
    return out, n, names, at, off


def votes(share: np.ndarray, n: np.ndarray) -> np.ndarray:
    """-1 bad, 1 good, 0 none, by text and heuristic; texts without words get no vote."""
    out = np.zeros(share.shape, np.int64)
    for j, (name, bad, good) in enumerate(HEURISTICS):
        s = share[:, j]
        if name == "distinct":
            out[:, j] = np.where((s <= bad) & (n >= 10), -1, np.where(s >= good, 1, 0))
        else:
            out[:, j] = np.where(s >= bad, -1, np.where(s <= good, 1, 0))
    out[n == 0] = 0
    return out


def label_model(patterns: np.ndarray, counts: np.ndarray, steps: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of good by pattern, P(vote | class) [class, voter, vote + 1], prior of good) by
    expectation-maximisation, from each voter's majority as the start."""
    total = patterns.sum(axis=1)
    post = np.clip(0.5 + 0.5 * np.tanh(total / 2.0), 0.02, 0.98)
    post = np.where((patterns == -1).any(axis=1), np.minimum(post, 0.4), post)
    table, prior = np.zeros((2, patterns.shape[1], 3)), 0.5
    onehot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(steps):
        before = post
        for c, w in enumerate((1 - post, post)):
            table[c] = np.einsum("p,pjv->jv", counts * w, onehot) + 0.1
            table[c] /= table[c].sum(axis=1, keepdims=True)
        prior = float(np.clip((counts * post).sum() / max(counts.sum(), 1), 1e-4, 1 - 1e-4))
        logs = [np.log(p) + np.einsum("pjv,jv->p", onehot, np.log(table[c])) for c, p in ((0, 1 - prior), (1, prior))]
        post = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        if np.abs(post - before).max(initial=0) < 1e-9:
            break
    return post, table, prior


def bucket(word: str) -> int:
    """Hash of a word's form: letters by case and digits in runs, other marks as they are."""
    out = []
    for c in word[:48]:
        k = "0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        if len(out) < 2 or out[-1] != k or out[-2] != k:
            out.append(k)
    return zlib.crc32("".join(out[:16]).encode("utf-8", "surrogatepass")) % WORD_BUCKETS


def feature_rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) triples and the word counts: a text's words by bucket as shares, and
    each heuristic's share as one of ``LEVELS`` levels."""
    share, n, names, at, off = shares(texts)
    known = kept(("quality",), dict)
    if len(known) > MEMORY:
        known.clear()
    words = strings(names)
    table = numbers(known, words)
    for i in np.flatnonzero(table < 0).tolist():
        table[i] = bucket(words[i])
        if len(words[i]) <= 100:
            known[words[i]] = int(table[i])
    doc = np.repeat(np.arange(len(n)), n)
    key, c = np.unique(doc * WORD_BUCKETS + table[at], return_counts=True)
    row, col = key // WORD_BUCKETS, key % WORD_BUCKETS
    some = np.flatnonzero(n)
    level = np.minimum((share[some] * LEVELS).astype(int), LEVELS - 1) + WORD_BUCKETS + LEVELS * np.arange(len(HEURISTICS))
    return (np.concatenate([row, np.repeat(some, len(HEURISTICS))]), np.concatenate([col, level.ravel()]),
            np.concatenate([c / n[row], np.ones(level.size)]), n)


def train(texts: pa.Array, target: np.ndarray, steps: int = 300, rate: float = 0.05, l2: float = 1e-3) -> np.ndarray:
    """Weights and, last, the bias of a logistic scorer fitted to soft targets (Adam)."""
    row, col, val, n = feature_rows(texts)
    x = np.zeros((len(n), N_FEATURES + 1), np.float32)
    np.add.at(x, (row, col), val)
    x[:, -1] = 1
    w, m, v = np.zeros(N_FEATURES + 1), np.zeros(N_FEATURES + 1), np.zeros(N_FEATURES + 1)
    weight = np.where(target >= 0.5, 0.5 / max((target >= 0.5).sum(), 1), 0.5 / max((target < 0.5).sum(), 1))
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -30, 30)))
        g = (weight * (p - target)).astype(np.float32) @ x + l2 * np.append(w[:-1], 0)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    return w


def scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Probability of good of each text; 0 for texts without words."""
    row, col, val, n = feature_rows(texts)
    z = np.bincount(row, val * weights[col], minlength=len(n)) + weights[-1]
    return np.where(n > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0)


def vote_patterns(docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(doc_id, h, pattern, short) of every row with words; a pattern has one letter (b, n, g) a voter,
    ``short`` texts have at most ``TRAIN_BYTES``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            share, n, *_ = shares(texts_of(b.column(2)))
            letters = np.array(list("bng"))[votes(share, n) + 1]
            keep = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep)), b.column(1).take(pa.array(keep)),
                 pa.array(["".join(letters[i]) for i in keep], pa.string()), b.column(3).take(pa.array(keep))],
                names=["doc_id", "h", "pattern", "short"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("h"), F.col("text").cast("string"),
                       (F.octet_length("text") <= TRAIN_BYTES).alias("short")).mapInArrow(run, "doc_id long, h long, pattern string, short boolean")
    if labels is None:
        return rows
    own = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("q"))
    vote = F.when(F.col("q") == 1, "g").when(F.col("q") == 0, "b").otherwise("n")
    return rows.join(own, rows["doc_id"] == own["_id"], "left").select("doc_id", "h", F.concat("pattern", vote).alias("pattern"), "short")


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame | None, n: int = TRAIN_DOCS) -> tuple[np.ndarray, dict]:
    """(scorer's weights, posterior of good by pattern). The vote patterns of all rows are counted
    (3 ^ voters patterns at most reach the driver); the scorer sees the ``n`` rows with the least
    hashes of doc_id and text on either side of an even posterior, among those whose text has at most
    ``TRAIN_BYTES``. Of several labels of one doc_id the least counts; a label with a null doc_id is nobody's."""
    prepare(spark)
    rows = materialize(spark, vote_patterns(docs, labels), "votes")
    seen = rows.groupBy("pattern").count().orderBy("pattern").collect()
    if not seen:
        return np.zeros(N_FEATURES + 1), {}
    patterns = np.array([["bng".index(c) - 1 for c in r["pattern"]] for r in seen])
    post, _, _ = label_model(patterns, np.array([r["count"] for r in seen], float))
    by = {r["pattern"]: float(p) for r, p in zip(seen, post)}
    table = spark.createDataFrame(list(by.items()), "pattern string, p double")
    rows = rows.join(F.broadcast(table), "pattern")
    texts, target = [], []
    for good in (True, False):
        pick = rows.where(F.col("short") & ((F.col("p") >= 0.5) == good)).orderBy("h", "doc_id").limit(n).select(
            F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "p").dropDuplicates(["_d", "_h"])
        own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                          F.xxhash64("doc_id", "text").alias("h"))
        got = own.join(F.broadcast(pick), own["doc_id"].eqNullSafe(F.col("_d")) & (own["h"] == F.col("_h"))) \
            .orderBy("h", "doc_id").limit(n).select("text", "p").collect()
        texts += [r["text"] for r in got]
        target += [r["p"] for r in got]
    return train(pa.array(texts, pa.string()), np.array(target)), by


def quality_scores(spark: SparkSession, docs: DataFrame, weights: np.ndarray, least: float = 0.5) -> DataFrame:
    """doc_id, score (0 to 1), keep of every row of ``docs``. Texts that are null or hold no words
    have score 0 and are not kept. Repeated rows and null ids are returned as they come; other
    columns are not looked at; empty tables give no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = scores(texts_of(b.column(1)), weights)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array(s >= least)], names=["doc_id", "score", "keep"])

    prepare(spark)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, score double, keep boolean")


def keep_good(spark: SparkSession, docs: DataFrame, weights: np.ndarray, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_scores` keeps, with all their columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(scores(texts_of(b.column(b.schema.get_field_index("text"))), weights) >= least))

    prepare(spark)
    return docs.mapInArrow(run, docs.schema)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    weights, _ = fit(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_scores(spark, docs, weights)
