"""Operator 11: I-Match fingerprints from several randomised lexicon subsets.

Terms are lower-cased (A-Z) words. The lexicon holds the terms whose inverse document frequency
ln(documents / document frequency) lies in a band, ``ln(1 / MOST)`` to ``ln(1 / LEAST)``. A text's
signature is a hash of its distinct lexicon terms in sorted order, once for the whole lexicon and
once for each of 64 subsets: subset j keeps a term with probability 2^-(1 + 2 (j mod 8)), drawn
from a hash of the term. The sparse subsets serve long texts, the dense ones short texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepforge.llm.common import BATCH_ROWS, documents, partitions, prepare, split_words, strings, texts_of

#: The lexicon: terms in at least one of LEAST and at most one of MOST documents. A corpus whose
#: documents hold d distinct terms on average has at most d * LEAST such terms, however many
#: documents there are, so the lexicon can be broadcast.
LEAST, MOST = 1000, 20
SUBSETS = 64
SHIFTS = np.array([1 + 2 * (j % 8) for j in range(SUBSETS)])
#: Signature of a subset that none of the text's terms is in.
NONE = "-" * 8
#: A task's counts are added up whenever so many have come together.
COUNTS = 1_000_000


def term_hashes(terms: pa.Array) -> np.ndarray:
    from xxhash import xxh64_intdigest
    return np.fromiter((xxh64_intdigest(t, 11) for t in strings(terms)), np.uint64, len(terms))


def distinct_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The batch's distinct terms; (text, term) numbers of each text's distinct terms."""
    words, off = split_words(pc.ascii_lower(texts))
    d = words.dictionary_encode()
    doc = np.repeat(np.arange(len(off) - 1, dtype=np.int64), np.diff(off))
    pairs = np.unique(doc * max(len(d.dictionary), 1) + d.indices.to_numpy())
    return d.dictionary, pairs // max(len(d.dictionary), 1), pairs % max(len(d.dictionary), 1)


def lexicon(spark: SparkSession, docs: DataFrame, least: int = LEAST, most: int = MOST) -> np.ndarray:
    """Sorted uint64 hashes of the terms within the band, from the document frequencies of all
    terms of all rows. Counts are added up in each task before they are shuffled."""
    def add(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        h, n = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
        if not len(h):
            return h, n
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        return h[first], np.add.reduceat(n, first)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def out():
            h, n = add(held)
            for i in range(0, len(h), 65536):
                yield pa.RecordBatch.from_arrays([pa.array(h[i:i + 65536].view(np.int64)), pa.array(n[i:i + 65536])],
                                                 names=["h", "n"])
        for b in batches:
            terms, _, term = distinct_terms(texts_of(b.column(0)))
            held.append((term_hashes(terms), np.bincount(term, minlength=len(terms)).astype(np.int64)))
            size += len(terms)
            if size > COUNTS:
                held = [add(held)]
                size = len(held[0][0])
                if size > COUNTS // 2:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()

    total = docs.count()
    df = docs.select(F.col("text").cast("string")).mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    df = df.where((F.col("n") * least >= total) & (F.col("n") * most <= total))
    return np.sort(df.select("h").toArrow().column(0).to_numpy().view(np.uint64))


_MASKS: dict[str, int] = {}


def subset_mask(term: str) -> int:
    """Bit j is set if subset j of the lexicon keeps the term."""
    if term not in _MASKS:
        if len(_MASKS) > 500_000:
            _MASKS.clear()
        v = [int(h[i:i + 8], 16) for g in range(SUBSETS // 4)
             for h in (hashlib.md5(f"{term}:{g}".encode()).hexdigest(),) for i in (0, 8, 16, 24)]
        _MASKS[term] = sum(1 << j for j in range(SUBSETS) if v[j] < 1 << (32 - int(SHIFTS[j])))
    return _MASKS[term]


def fingerprints(texts: pa.Array, lex: np.ndarray) -> list[str]:
    """A fingerprint of each text: 8 hex digits of the number of its lexicon terms, 16 of the hash
    of all of them, 8 for each subset (dashes: none of them is in it). A text without lexicon
    terms is hashed by all its terms, so that only equal sets of terms agree."""
    n_docs = len(texts)
    terms, doc, term = distinct_terms(texts)
    h = term_hashes(terms)
    at = np.searchsorted(lex, h)
    known = at < len(lex)
    known[known] = lex[at[known]] == h[known]
    order = pc.sort_indices(terms.cast(pa.binary())).to_numpy()  # by bytes, so by code points
    rank = np.empty(len(terms), np.int64)
    rank[order] = np.arange(len(terms))
    sorted_terms = np.array([*strings(terms.take(pa.array(order))), None], object)[:-1]
    byte_terms = np.array([*(t.encode() for t in sorted_terms), None], object)[:-1]
    has = np.zeros(n_docs, bool)
    has[doc[known[term]]] = True
    use = known[term] | ~has[doc]
    doc, r = doc[use], rank[term[use]]
    by = np.lexsort((r, doc))
    doc, r = doc[by], r[by]
    off = np.searchsorted(doc, np.arange(n_docs + 1))
    md5 = hashlib.md5
    out = []
    names = byte_terms[r].tolist()
    for i in range(n_docs):
        whole = md5(b" ".join(names[off[i]:off[i + 1]])).hexdigest()[:16]
        out.append([f"{off[i + 1] - off[i] if has[i] else 0:08x}{whole}", *[NONE] * SUBSETS])
    masks = np.zeros(len(terms), np.uint64)
    kept = np.flatnonzero(known[order])
    masks[kept] = np.fromiter(map(subset_mask, sorted_terms[kept]), np.uint64, len(kept))
    m = masks[r]
    for j in range(SUBSETS):
        idx = np.flatnonzero((m >> np.uint64(j)) & np.uint64(1))
        if not len(idx):
            continue
        own = doc[idx]
        cut = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]]))
        picked = byte_terms[r[idx]].tolist()
        for i, a, b in zip(own[cut[:-1]].tolist(), cut[:-1].tolist(), cut[1:].tolist()):
            out[i][j + 1] = md5(b" ".join(picked[a:b])).hexdigest()[:8]
    return ["".join(x) for x in out]


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """For each pair of fingerprints 1 if they are equal, else the share of equal signatures among
    the subsets in which either text has terms. Only subsets that keep fewer than two terms of
    the larger text on average count (the sparsest always do), which makes the share an estimate
    of the overlap of the two sets of lexicon terms."""
    if not a:
        return np.zeros(0)
    x, y = np.array(a, "S536"), np.array(b, "S536")
    sx, sy = (v.view("S8").reshape(len(a), 67)[:, 3:] for v in (x, y))
    n = np.maximum([int(v[:8], 16) for v in a], [int(v[:8], 16) for v in b])
    use = (n[:, None] < (2 << SHIFTS)[None, :]) | (SHIFTS == SHIFTS.max())[None, :]
    use &= (sx != NONE.encode()) | (sy != NONE.encode())
    same = (use & (sx == sy)).sum(axis=1)
    return np.where(x == y, 1.0, same / np.maximum(use.sum(axis=1), 1))


def _keys(null: np.ndarray, ids: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Byte strings that sort like (null, doc_id, hash)."""
    raw = np.empty((len(ids), 17), np.uint8)
    raw[:, 0] = null
    for at, v in ((1, ids), (9, h)):
        raw[:, at:at + 8] = (v.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
    return raw.view("S17").ravel()


def with_next(docs: DataFrame, n: int) -> DataFrame:
    """(part, halo, nul, doc_id, h, text), sorted within partitions, where the row after a row is its
    successor by (doc_id nulls last, hash of the text). Ranges of keys go to partitions; the first
    row of each range is dealt to the range before, too, as its last row (``halo`` 1); the first
    range's goes to the last."""
    keyed = docs.select(F.col("doc_id").isNull().cast("int").alias("nul"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = ["nul", "doc_id", "h"]
    starts = keyed.select(*order).repartitionByRange(n, *order).groupBy(F.spark_partition_id().alias("p")) \
        .agg(F.min(F.struct(*order)).alias("x")).select("x.*").collect()  # one row a partition
    starts = np.sort(_keys(*(np.array([r[c] for r in starts], np.int64) for c in order))) if starts else np.zeros(0, "S17")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = _keys(*(b.column(i).to_numpy() for i in range(3)))
            part = np.searchsorted(starts, key, side="right") - 1
            for halo, rows in ((0, np.arange(len(part))), (1, np.flatnonzero(starts[part] == key))):
                p = part[rows] if not halo else (part[rows] - 1) % len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p.astype(np.int32)), pa.array(np.full(len(rows), halo, np.int32)), *b.take(pa.array(rows)).columns],
                    names=["part", "halo", *order, "text"])

    return keyed.mapInArrow(deal, "part int, halo int, nul int, doc_id long, h long, text string") \
        .repartitionById(n, F.col("part")).sortWithinPartitions("part", "halo", *order)


def edited(text: str, other: str) -> str:
    """The last half of the code points replaced by as many (or all) of the other text's first."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def imatch(spark: SparkSession, docs: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, next_doc_id, n_terms.

    ``near_edited`` and ``near_next`` compare the fingerprint with that of the row's edited text
    (see :func:`edited`) and of the next row. Rows are in order of doc_id, nulls last, on a tie in order
    of a hash of the text (equal texts in any order); the row after the last is the first, so a
    single row follows itself. Null and empty texts are equal and hold no terms; a text without
    lexicon terms is told apart by all its terms. Repeated rows are all returned. Empty tables give
    no rows; other columns are not looked at.
    """
    prepare(spark)
    lex = spark.sparkContext.broadcast(lexicon(spark, docs, least, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pend: tuple | None = None  # (part, nul, doc_id, text) of the row whose successor is still to come
        rows: list[tuple] = []
        size = 0

        def out():
            own, nxt = [r[3] for r in rows], [r[5] for r in rows]
            new = [edited(a, b) for a, b in zip(own, nxt)]
            # a row's successor is mostly the next row: fingerprint it once
            extra = [i for i in range(len(rows)) if i + 1 == len(rows) or nxt[i] is not own[i + 1]]
            fp = fingerprints(pa.array([*own, *new, *(nxt[i] for i in extra)], pa.string()), lex.value)
            k = len(rows)
            after = [*fp[1:k], ""]
            for i, x in zip(extra, fp[2 * k:]):
                after[i] = x
            ids = lambda nul, v: pa.array([None if z else x for z, x in zip(nul, v)], pa.int64())
            return pa.RecordBatch.from_arrays([
                ids([r[1] for r in rows], [r[2] for r in rows]), pa.array([len(t) for t in own], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
                pa.array(fp[:k], pa.string()), pa.array(fp[k:2 * k], pa.string()),
                pa.array(likeness(fp[:k], fp[k:2 * k])), pa.array(likeness(fp[:k], after)),
                ids([r[6] for r in rows], [r[7] for r in rows]), pa.array([int(x[:8], 16) for x in fp[:k]], pa.int64())],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
                       "next_doc_id", "n_terms"])

        for b in batches:
            part, halo, nul, ids = (b.column(i).to_pylist() for i in range(4))
            for p, hl, nu, i, t in zip(part, halo, nul, ids, strings(b.column(5))):
                if pend is not None and pend[0] == p:
                    rows.append((*pend, hl, t, nu, i))
                    size += len(pend[3])
                pend = None if hl else (p, nu, i, t)
                if len(rows) >= BATCH_ROWS // 2 or size > 8_000_000:
                    yield out()
                    rows, size = [], 0
        if rows:
            yield out()

    return with_next(docs.select("doc_id", "text"), partitions(spark)).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double, next_doc_id long, n_terms long")


def op11_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch(spark, documents(spark, sf_dir))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, COALESCE(text, '') AS text, row_number() OVER (ORDER BY doc_id) - 1 AS k, count(*) OVER () AS total FROM documents),
n AS (SELECT a.doc_id, a.text, b.doc_id AS next_doc_id, b.text AS other FROM d a JOIN d b ON b.k = (a.k + 1) % a.total),
t AS (
  SELECT 0 AS kind, doc_id, text FROM d UNION ALL
  SELECT 1, doc_id, substr(text, 1, length(text) - length(text) // 2) || substr(other, 1, length(text) // 2) FROM n),
u AS (
  SELECT kind, doc_id, unnest(list_distinct(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'))) AS term FROM t),
lex AS (
  SELECT term FROM u WHERE kind = 0 GROUP BY term
  HAVING count(*) * 1000 >= (SELECT count(*) FROM d) AND count(*) * 20 <= (SELECT count(*) FROM d)),
sub AS (
  SELECT term, j FROM (SELECT term, j, ('0x' || substr(md5(term || ':' || (j // 4)), CAST(1 + 8 * (j % 4) AS INT), 8))::BIGINT AS v
    FROM lex, range(64) r(j)) WHERE v < (1::BIGINT << CAST(31 - 2 * (j % 8) AS INT))),
kept AS (SELECT u.* FROM u JOIN lex USING (term)),
whole AS (
  SELECT t.kind, t.doc_id, count(kept.term) AS n,
    substr(md5(COALESCE(string_agg(kept.term, ' ' ORDER BY kept.term), '')), 1, 16) AS sig
  FROM t LEFT JOIN kept ON t.kind = kept.kind AND t.doc_id = kept.doc_id GROUP BY t.kind, t.doc_id),
bare AS (
  SELECT kind, doc_id, substr(md5(string_agg(term, ' ' ORDER BY term)), 1, 16) AS sig
  FROM u SEMI JOIN (SELECT * FROM whole WHERE n = 0) USING (kind, doc_id) GROUP BY kind, doc_id),
part AS (
  SELECT kind, doc_id, j, substr(md5(string_agg(term, ' ' ORDER BY term)), 1, 8) AS s FROM kept JOIN sub USING (term) GROUP BY kind, doc_id, j),
sigs AS (
  SELECT w.kind, w.doc_id, w.n, list(COALESCE(part.s, '--------') ORDER BY r.j) AS s
  FROM whole w CROSS JOIN range(64) r(j) LEFT JOIN part ON part.kind = w.kind AND part.doc_id = w.doc_id AND part.j = r.j
  GROUP BY w.kind, w.doc_id, w.n),
fp AS (
  SELECT s.kind, s.doc_id, s.n, s.s, printf('%08x', s.n) || COALESCE(bare.sig, w.sig) || array_to_string(s.s, '') AS f
  FROM sigs s JOIN whole w USING (kind, doc_id) LEFT JOIN bare USING (kind, doc_id)),
pairs AS (
  SELECT a.doc_id, 'e' AS what, a.f AS f, b.f AS g, a.s AS s, b.s AS z, greatest(a.n, b.n) AS n
  FROM fp a JOIN fp b ON a.doc_id = b.doc_id AND a.kind = 0 AND b.kind = 1 UNION ALL
  SELECT a.doc_id, 'n', a.f, b.f, a.s, b.s, greatest(a.n, b.n)
  FROM fp a JOIN n ON n.doc_id = a.doc_id AND a.kind = 0 JOIN fp b ON b.doc_id = n.next_doc_id AND b.kind = 0),
near AS (
  SELECT doc_id, what, CASE WHEN any_value(f = g) THEN 1.0::DOUBLE ELSE
    count(*) FILTER (ok AND x = y)::DOUBLE / greatest(count(*) FILTER (ok), 1) END AS near
  FROM (SELECT doc_id, what, f, g, x, y, (n < (2 << (1 + 2 * (j % 8))) OR j % 8 = 7) AND (x <> '--------' OR y <> '--------') AS ok
    FROM (SELECT doc_id, what, f, g, n, unnest(s) AS x, unnest(z) AS y, unnest(range(64)) AS j FROM pairs)) GROUP BY doc_id, what)
SELECT n.doc_id, CAST(length(n.text) AS BIGINT) AS n_chars, sha256(t.text) AS edited_sha256, a.f AS fingerprint, b.f AS edited_fingerprint,
  x.near AS near_edited, y.near AS near_next, n.next_doc_id, CAST(a.n AS BIGINT) AS n_terms
FROM n JOIN t ON t.doc_id = n.doc_id AND t.kind = 1 JOIN fp a ON a.doc_id = n.doc_id AND a.kind = 0
JOIN fp b ON b.doc_id = n.doc_id AND b.kind = 1 JOIN near x ON x.doc_id = n.doc_id AND x.what = 'e' JOIN near y ON y.doc_id = n.doc_id AND y.what = 'n'
"""
