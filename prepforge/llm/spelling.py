"""Operator 13: spelling variants, found by walking a trie of all words relation by relation.

The trie is path-compressed and kept as an edge table (node, label, term): a node is named by its
prefix, an edge carries the letters down to the next node, and ``term`` says that a word ends there.
A word that differs from another by one edit leaves the other's path at a branching node. So
the frontier starts as states (word, position, node, no edit) at the branching nodes on every word's
own path. The first join with the edges makes the edit, a replaced or a left-out letter; each
later one takes the states with one edit down one more edge, until they end where a word ends or
the frontier is empty. Added letters are left-out letters seen from the other word.

Words are stored forward and backward and only edits in the second half of either are looked
for, so no state starts at the crowded nodes near the root.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepforge.llm.common import documents, gather, materialize, partitions, prepare, split_words, strings, texts_of

#: Fixed values of the task: letters of a run after lower-casing, the share of runs that lose a letter,
#: the least length and count of a word, how many times as frequent a form is.
OTHERS, LOSES, MIN_LENGTH, MIN_COUNT, TIMES = r"[^a-z\x{C0}-\x{FF}]+", 31, 7, 2, 10
#: Words of a task that are added up before they go on.
COUNTS = 500_000


def batch_counts(ids: list, texts: pa.Array) -> tuple[list[str], list[int]]:
    """Words of at least ``MIN_LENGTH`` letters and their counts in a batch, a word several times
    in some cases."""
    words, off = split_words(texts)
    d = words.dictionary_encode()
    parts = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(d.dictionary), OTHERS, " "))
    flat = parts.flatten()
    owner = np.repeat(np.arange(len(parts), dtype=np.int64), np.diff(parts.offsets.to_numpy()))
    long = pc.greater_equal(pc.utf8_length(flat), MIN_LENGTH)
    owner = owner[long.to_numpy(zero_copy_only=False)]
    runs = flat.filter(long).dictionary_encode()
    if not len(runs):
        return [], []
    names, code = strings(runs.dictionary), runs.indices.to_numpy().astype(np.int64)
    first = np.searchsorted(owner, np.arange(len(d.dictionary) + 1))
    doc = np.repeat(np.arange(len(off) - 1, dtype=np.int64), np.diff(off))
    pair, times = np.unique(doc * len(d.dictionary) + d.indices.to_numpy(), return_counts=True)
    doc, word = pair // len(d.dictionary), pair % len(d.dictionary)
    n = np.diff(first)[word]
    run = gather(code, first[:-1][word], n)
    key, back = np.unique(np.repeat(doc, n) * len(names) + run, return_inverse=True)
    times = np.bincount(back, np.repeat(times, n), len(key)).astype(np.int64)
    doc, run = key // len(names), key % len(names)
    starts = [crc32(b"%s:" % (b"" if i is None else str(i).encode())) for i in ids]
    raw = [x.encode() for x in names]
    h = np.fromiter((crc32(raw[r], starts[i]) for i, r in zip(doc.tolist(), run.tolist())), np.int64, len(run))
    odd = h % LOSES == 0
    total = np.bincount(run[~odd], times[~odd], len(names)).astype(np.int64)
    out, counts = [names[i] for i in np.flatnonzero(total)], total[total > 0].tolist()
    for r, x, k in zip(run[odd].tolist(), h[odd].tolist(), times[odd].tolist()):
        w = names[r]
        if len(w) > MIN_LENGTH:
            at = x % len(w)
            out.append(w[:at] + w[at + 1:])
            counts.append(k)
    return out, counts


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of at least ``MIN_LENGTH`` letters and ``MIN_COUNT`` occurrences.
    A null doc_id is written as the empty string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0

        def add():
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
        for b in batches:
            w, n = batch_counts(b.column(0).to_pylist(), texts_of(b.column(1)))
            held.append(pa.table({"word": pa.array(w, pa.string()), "n": pa.array(n, pa.int64())}))
            size += len(w)
            if size > COUNTS:
                held = [add()]
                size = len(held[0])
                if size > COUNTS // 2:
                    yield from held[0].to_batches(65536)
                    held, size = [], 0
        if held:
            yield from add().to_batches(65536)

    return docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string")).mapInArrow(run, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    i = 0
    while a[i] == b[i]:
        i += 1
    return i


def branches(xs: list[str], before: str, after: str, least: int) -> list[list[int]]:
    """For each of the sorted words ``xs`` the depths (``least`` at least) of the branching nodes on its
    path, given the words before and after them. Nodes with words beyond either end count as
    branching, so that whoever has a part of their words agrees."""
    n = len(xs)
    lcp = [common(before, xs[0]), *(common(xs[i - 1], xs[i]) for i in range(1, n)), common(xs[-1], after)]
    left: list[list[int]] = []
    stack = list(range(least, lcp[0] + 1))
    for i in range(n):
        while stack and stack[-1] > lcp[i]:
            stack.pop()
        if lcp[i] >= least and (not stack or stack[-1] < lcp[i]):
            stack.append(lcp[i])
        left.append(stack[:])
    stack = list(range(least, lcp[n] + 1))
    for i in range(n - 1, -1, -1):
        while stack and stack[-1] > lcp[i + 1]:
            stack.pop()
        if lcp[i + 1] >= least and (not stack or stack[-1] < lcp[i + 1]):
            stack.append(lcp[i + 1])
        left[i] = sorted({*left[i], *stack})
    return left


#: A stored word begins with its direction (0 forward, 1 backward). Depth of the highest node that an
#: edit in the second half of a word of ``MIN_LENGTH`` letters can leave from.
LEAST_DEPTH = 1 + MIN_LENGTH // 2


def trie(spark: SparkSession, words: DataFrame) -> DataFrame:
    """Rows (kind, node, x, at): kind 0 are edges (x the label, at 1 if a word ends below it), kind 1
    the starting states (x the word in its direction, at the node's depth), kind 2 candidates that need
    no edge: x without its last letter is the node itself. Words in both directions are sorted by
    ranges; a range knows the last word before it and the first after it."""
    n = partitions(spark)
    both = words.select(F.explode(F.array(F.concat(F.lit("0"), "word"), F.concat(F.lit("1"), F.reverse("word")))).alias("x"))
    ends = sorted((r["a"], r["b"]) for r in both.repartitionByRange(n, "x").groupBy(F.spark_partition_id().alias("p"))
                  .agg(F.min("x").alias("a"), F.max("x").alias("b")).collect())  # one row a partition
    starts = [a for a, _ in ends]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = [bisect_right(starts, x) - 1 for x in strings(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), b.column(0)], names=["part", "x"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(part: int, xs: list[str]):
            depths = branches(xs, ends[part - 1][1] if part else "", ends[part + 1][0] if part + 1 < len(ends) else "", LEAST_DEPTH)
            kinds, nodes, labels, at = [], [], [], []
            last = ends[part - 1][1] if part else ""
            for x, own in zip(xs, depths):
                shared, last = common(last, x), x
                size = len(x) - 1
                half = 1 + (size // 2 if x[0] == "0" else size - size // 2)
                path = own if own and own[-1] == len(x) else [*own, len(x)]
                for d, e in zip(path, path[1:]):
                    if e > shared:  # else the word before went the same way
                        kinds.append(0)
                        nodes.append(x[:d])
                        labels.append(x[d:e])
                        at.append(int(e == len(x)))
                for d in own:
                    if half <= d < len(x):
                        kinds.append(1)
                        nodes.append(x[:d])
                        labels.append(x)
                        at.append(d)
                        if d == len(x) - 1:
                            kinds.append(2)
                            nodes.append(x[:d])
                            labels.append(x)
                            at.append(d)
            for i in range(0, len(kinds), 65536):
                s = slice(i, i + 65536)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds[s], pa.int32()), pa.array(nodes[s], pa.string()), pa.array(labels[s], pa.string()), pa.array(at[s], pa.int32())],
                    names=["kind", "node", "x", "at"])
        now, xs = None, []
        for b in batches:
            for p, x in zip(b.column(0).to_pylist(), strings(b.column(1))):
                if p != now and xs:
                    yield from out(now, xs)
                    xs = []
                now = p
                xs.append(x)
        if xs:
            yield from out(now, xs)

    return materialize(spark, both.mapInArrow(deal, "part int, x string").repartitionById(n, F.col("part"))
                       .sortWithinPartitions("part", "x").mapInArrow(build, "kind int, node string, x string, at int"), "trie")


def near_pairs(spark: SparkSession, words: DataFrame) -> DataFrame:
    """(word, other), both ways round, of all words that differ by exactly one inserted, deleted or
    replaced letter. ``words`` (column ``word``) must be distinct."""
    rows = trie(spark, words)
    edges = rows.where("kind = 0").select("node", F.col("x").alias("label"), F.col("at").alias("term"))
    start = rows.where("kind = 1").select("node", "x", "at")
    # the edit: leave the own path by an edge with another first letter; x[at] is replaced by it or left out
    rest = lambda skip: f"substring(x, at + 2, length(label) - {skip})"
    replaced = F.expr(f"left(label, 1) > substring(x, at + 1, 1) and {rest(1)} = substring(label, 2)")
    left_out = F.expr(f"left(label, 1) <> substring(x, at + 1, 1) and {rest(0)} = label")
    both = F.array(F.when(replaced, F.expr("concat(left(x, at), left(label, 1), substring(x, at + 2))")),
                   F.when(left_out, F.expr("concat(left(x, at), substring(x, at + 2))")))
    states = start.join(edges, "node").where(replaced | left_out) \
        .select("x", F.explode(both).alias("v"), (F.col("at") + F.length("label")).alias("at"), "term").where("v is not null")
    found = rows.where("kind = 2").select("x", F.col("node").alias("v"))
    level = materialize(spark, states, "frontier")
    while True:
        found = found.unionByName(level.where("at = length(v) and term = 1").select("x", "v"))
        ahead = level.where("at < length(v)").select("x", "v", "at", F.expr("left(v, at)").alias("node"))
        if ahead.isEmpty():
            break
        e = edges.withColumn("first", F.expr("left(label, 1)"))
        ahead = ahead.withColumn("first", F.expr("substring(v, at + 1, 1)"))
        level = materialize(spark, ahead.join(e, ["node", "first"]).where("substring(v, at + 1, length(label)) = label")
                            .select("x", "v", (F.col("at") + F.length("label")).alias("at"), "term"), "frontier")
    turn = lambda c: F.when(F.col(c).startswith("0"), F.substring(c, 2, 1 << 30)).otherwise(F.reverse(F.substring(c, 2, 1 << 30)))
    pairs = found.select(turn("x").alias("word"), turn("v").alias("other")).distinct()
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))


def spelling_variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of all words of ``docs``.

    A word's form is its near word of largest n (ties: the smallest), if that is at least ``TIMES``
    its own n, else null; the root is where the forms lead. Counts rise tenfold with each form, so
    a chain of forms has at most 19 and is followed by doubling in a few rounds. Null texts hold
    no words; a null doc_id is written as the empty string before the colon. Repeated rows count
    each time. Empty tables give no rows; other columns are not looked at.
    """
    prepare(spark)
    words = materialize(spark, word_counts(docs), "words")
    near = near_pairs(spark, words).join(words.select(F.col("word").alias("other"), F.col("n").alias("m")), "other") \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("neg"), "other")).alias("best"))
    ok = -F.col("best.neg") >= TIMES * F.col("n")
    out = materialize(spark, words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(ok, F.col("best.other")).alias("form"), F.when(ok, -F.col("best.neg")).alias("form_n")), "forms")
    chain = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        step = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        nxt = materialize(spark, chain.join(step, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        chain = nxt.select("word", "root")
        if nxt.where("moved").isEmpty():
            break
    return out.join(chain, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(spark, documents(spark, sf_dir))


OP13_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END) AS c FROM range(256) r(i))),
runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-zÀ-ÿ]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY doc_id, run),
hashed AS (
  SELECT doc_id, run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
        ELSE [(192 + unicode(c) // 64)::BIGINT, (128 + unicode(c) % 64)::BIGINT] END))),
    lambda a, b: xor(a // 256, crc.t[1 + xor(a % 256, b)])), 4294967295::BIGINT) AS h
  FROM runs, crc),
words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, k FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
cut AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT word, CAST(unnest(range(1, length(word) + 1)) AS INT) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.less = b.less AND length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT cut.word, words.word FROM cut JOIN words ON cut.less = words.word
  UNION SELECT words.word, cut.word FROM cut JOIN words ON cut.less = words.word),
best AS (
  SELECT p.word, count(*) AS n_near, list(p.other ORDER BY w.n DESC, p.other)[1] AS other, max(w.n) AS m
  FROM pairs p JOIN words w ON w.word = p.other GROUP BY p.word),
forms AS (
  SELECT words.word, n, COALESCE(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
roots AS (SELECT word, max_by(root, step) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""
