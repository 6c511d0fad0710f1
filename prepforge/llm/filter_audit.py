"""Operator 12: filter interaction audit over every order of five filters.

A counting Bloom filter over text hashes clears the texts that occur once: each task counts its
own texts, the sketches are merged slice by slice, and a text one of whose counters is 1 is
unique. Only the others, the possible repeats, are shuffled for the exact least doc_id of their full
text. The five flags of a row make a mask, and all figures come from counts per part and mask.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations as orders_of
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepforge.llm.common import documents, materialize, partitions, prepare, split_words, texts_of

#: Filters in bit order (fixed values of the task): fewer than 50 words; under 65 % distinct words;
#: over 5 % capitals A-Z; one of the marks; a text that a smaller doc_id has, too.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, MARKS = 50, 65, 5, b"#$%&*|"
#: Counters a document, and the most counters: 2^28 make a bitmap of 32 MB, which is all that is
#: broadcast. Beyond 16 million documents the share of unique texts that are not cleared grows;
#: they take the exact way like real repeats, so the result is the same.
COUNTERS, MOST_COUNTERS = 16, 1 << 28
SLICE = 1 << 16

_CLASS = np.zeros((2, 256), np.uint8)
_CLASS[0, ord("A"):ord("Z") + 1] = 1
_CLASS[1, list(MARKS)] = 1


def places(h: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The two counters of each 64-bit hash."""
    u = h.view(np.uint64)
    return (u & np.uint64(m - 1)).astype(np.int64), ((u >> np.uint64(32)) & np.uint64(m - 1)).astype(np.int64)


def repeat_bits(spark: SparkSession, hashes: DataFrame, m: int) -> np.ndarray:
    """A bitmap of the counters (``m``, a power of two) that are 2 or more after counting every hash
    (one column, long) at its two places."""
    n = partitions(spark)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # places, twice those that are counted twice or more
        size = 0

        def shrink(parts):
            p, c = np.unique(np.concatenate(parts), return_counts=True)
            return np.repeat(p, np.minimum(c, 2))

        def out():
            p = shrink(held)
            part = p // SLICE
            cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            low = (p % SLICE).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[cut[:-1]].astype(np.int32)), pa.array([low[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                names=["slice", "low"])
        for b in batches:
            if b.num_rows:
                held += places(b.column(0).to_numpy(), m)
                size += 2 * b.num_rows
            if size > 4_000_000:
                held = [shrink(held)]
                size = len(held[0])
                if size > 2_000_000:
                    yield from out()
                    held, size = [], 0
        if size:
            yield from out()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, np.zeros(SLICE, np.uint8)

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([np.packbits(counts >= 2, bitorder="little").tobytes()], pa.binary())], names=["slice", "bits"])
        for b in batches:
            for s, low in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if s != now:
                    if now is not None:
                        yield out()
                    now = s
                    counts[:] = 0
                p, c = np.unique(np.frombuffer(low, np.uint16), return_counts=True)
                counts[p] = np.minimum(counts[p] + c, 2)
        if now is not None:
            yield out()

    slices = hashes.mapInArrow(count, "slice int, low binary").repartitionById(n, F.col("slice")) \
        .sortWithinPartitions("slice").mapInArrow(merge, "slice int, bits binary").toArrow()
    bits = np.zeros(m // 8, np.uint8)
    for s, raw in zip(slices.column(0).to_pylist(), slices.column(1).to_pylist()):
        bits[s * SLICE // 8:(s + 1) * SLICE // 8] = np.frombuffer(raw, np.uint8)
    return bits


def _sums(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(raw, dtype=np.int64)])
    return run[off[1:]] - run[off[:-1]]


def text_masks(texts: pa.Array) -> np.ndarray:
    """Bits of the filters A to D that each text fails."""
    words, off = split_words(texts)
    n = np.diff(off)
    d = words.dictionary_encode()
    many = max(len(d.dictionary), 1)
    pairs = np.unique(np.repeat(np.arange(len(n), dtype=np.int64), n) * many + d.indices.to_numpy())
    distinct = np.bincount(pairs // many, minlength=len(n))
    at = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8, int(at[-1])) if at[-1] else np.zeros(0, np.uint8)
    raw, at = raw[at[0]:], at - at[0]
    capitals, marks = (_sums(c[raw], at) for c in _CLASS)
    chars = pc.utf8_length(texts).to_numpy().astype(np.int64)
    fails = (n < MIN_WORDS, 100 * distinct < MIN_DISTINCT * n, 100 * capitals > MAX_CAPITALS * chars, marks > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(fails))


def flagged(spark: SparkSession, docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(doc_id, part, mask) of every row of ``docs``, ``mask`` holding a bit for each filter failed."""
    prepare(spark)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    d = d.withColumn("h", F.xxhash64("text"))
    m = SLICE
    while m < min(counters * docs.count(), MOST_COUNTERS):
        m *= 2
    bits = spark.sparkContext.broadcast(repeat_bits(spark, d.select("h"), m))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = texts_of(b.column(3))
            maybe = np.ones(b.num_rows, bool)
            for p in places(b.column(2).to_numpy(), m):
                maybe &= (bits.value[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text_masks(texts), pa.int32()), b.column(2),
                 pc.if_else(pa.array(maybe), texts, pa.scalar(None, pa.string()))], names=["doc_id", "part", "mask", "h", "text"])

    rows = materialize(spark, d.select("doc_id", "part", "h", "text").mapInArrow(
        run, "doc_id long, part string, mask int, h long, text string"), "audit")
    repeats = rows.where("text is not null")
    # written, so that the join below deals out both sides itself and a hot text can be split
    least = materialize(spark, repeats.groupBy("h", "text").agg(F.min("doc_id").alias("least")).where("least is not null"), "auditleast")
    e = F.when(F.col("doc_id") > F.col("least"), 1 << FILTERS.index("E")).otherwise(0)
    named = repeats.join(least, ["h", "text"], "left").select("doc_id", "part", (F.col("mask") + e).alias("mask"))
    return rows.where("text is null").select("doc_id", "part", "mask").unionByName(named)


def audit(spark: SparkSession, docs: DataFrame, labels: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Per part (source), order of the filters and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost and shapley, as the contract says.

    A null text counts as empty, a null source as the empty string. A row with a null doc_id is
    never the smaller one nor has it one smaller, and no label is its own. Rows that share a
    doc_id are counted one by one, and repeated rows tie, so neither fails filter E by the other.
    Of several labels of one doc_id, any with 1 counts. Parts without rows don't occur, so an
    empty table gives none. Other columns are not looked at.
    """
    rows = materialize(spark, flagged(spark, docs, counters), "auditmask")
    n = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"))
    one = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    judged = rows.join(one, "doc_id").groupBy("part", "mask").agg(F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    counts = n.join(judged, ["part", "mask"], "left").select(
        "part", "mask", "n", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])
    # for each filter (bit f) and each set of filters before it
    sets = 1 << (len(FILTERS) - 1)
    c = counts.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(len(FILTERS) * sets - 1)))) \
        .withColumn("f", F.expr(f"cast(c div {sets} as int)")).withColumn("s", F.col("c") % sets) \
        .withColumn("before", F.expr("shiftleft(shiftright(s, f), f + 1) | (s & (shiftleft(1, f) - 1))"))
    reach, fails = F.expr("(mask & before) = 0"), F.expr("(shiftright(mask, f) & 1) = 1")
    total = lambda cond, v: F.sum(F.when(cond, F.col(v)).otherwise(0))
    cell = c.groupBy("part", "f", "before").agg(
        total(reach & ~fails, "n").alias("kept"), total(reach & fails, "n").alias("removed"),
        total(~reach & fails, "n").alias("redundant"), total(F.expr("mask = shiftleft(1, f)"), "n").alias("unique_fails"),
        total(reach & fails, "good").alias("good_lost"), total(reach & fails, "toxic").alias("toxic_lost"))
    k = len(FILTERS) - 1
    ways = F.element_at(F.array(*[F.lit(factorial(i) * factorial(k - i)) for i in range(k + 1)]), F.bit_count("before") + 1)
    shapley = cell.groupBy("part", "f").agg(F.sum(F.col("removed") * ways).alias("shapley"))
    steps = [("".join(o), i + 1, FILTERS.index(x), sum(1 << FILTERS.index(y) for y in o[:i]))
             for o in orders_of(FILTERS) for i, x in enumerate(o)]
    steps = spark.createDataFrame(steps, "filter_order string, step int, f int, before int")  # 600 rows
    return cell.join(shapley, ["part", "f"]).join(F.broadcast(steps), ["f", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, COALESCE(good, 0) AS good, COALESCE(toxic, 0) AS toxic,
    CASE WHEN len(words) < 50 THEN 'A' ELSE '' END ||
    CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END ||
    CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) THEN 'C' ELSE '' END ||
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END ||
    CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
p AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT o, step, substr(o, step, 1) AS f, substr(o, 1, step - 1) AS before FROM p, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step)),
r AS (
  SELECT c.*, o, step, f, contains(fails, f) AS hit, step = 1 OR NOT regexp_matches(fails, '[' || before || '_]') AS reach FROM c, s),
g AS (
  SELECT part, o, step, f,
    CAST(COALESCE(sum(n) FILTER (reach AND NOT hit), 0) AS BIGINT) AS kept, CAST(COALESCE(sum(n) FILTER (reach AND hit), 0) AS BIGINT) AS removed,
    CAST(COALESCE(sum(n) FILTER (NOT reach AND hit), 0) AS BIGINT) AS redundant, CAST(COALESCE(sum(n) FILTER (fails = f), 0) AS BIGINT) AS unique_fails,
    CAST(COALESCE(sum(good) FILTER (reach AND hit), 0) AS BIGINT) AS good_lost, CAST(COALESCE(sum(toxic) FILTER (reach AND hit), 0) AS BIGINT) AS toxic_lost
  FROM r GROUP BY part, o, step, f)
SELECT part, o AS filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM g
"""
