"""Operator 2: token ids in Simple-8b words.

A 64-bit word holds a 4-bit selector and 60 bits of payload: ``COUNTS[s]`` ids of ``WIDTHS[s]``
bits, the first id lowest. Ids are packed in spans of 1,024 that begin on a word of their own;
the last word of a span may hold fewer ids than its selector says. An id of 2^60 - 1 or more
is escaped: selector 15 with all payload bits set, then the id itself as the next word.

A file set is a Parquet folder of blocks in ascending document order: ``part`` and ``block``
number them, ``before`` counts the ids of earlier blocks of the part, ``doc_ids`` and ``lens``
are the block's whole documents, ``offsets`` (uint32) the first word of each span, ``words``
(uint64) the words; both little-endian.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prepforge.llm.common import documents, encoder, partitions, prepare, texts_of
from prepforge.session import ensure_checkpoint_dir

#: Ids in a word and bits of an id by selector (fixed values of Simple-8b).
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
SPAN = 1024
BLOCK_IDS = 1 << 16
_ESCAPE = (1 << 60) - 1
_POWERS = np.array([1 << i for i in range(61)], np.uint64)

BLOCKS = ("part int, block int, before long, n_ids long, doc_ids array<bigint>, lens array<bigint>, "
          "offsets binary, words binary")


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each span) of unsigned 64-bit ids."""
    ids = ids.astype(np.uint64)
    n, rows = len(ids), -(-len(ids) // SPAN)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    flat = np.zeros(rows * SPAN, np.uint64)
    flat[:n] = ids
    escaped = flat >= _ESCAPE
    flat[escaped] = _ESCAPE
    pad = np.zeros((rows, SPAN + 240), np.uint64)
    pad[:, :SPAN] = flat.reshape(rows, SPAN)
    width = np.zeros((rows, SPAN + 240), np.uint8)
    # bit lengths: the exponent as a double, exact below 2^53
    bits = np.frexp(flat.astype(np.float64))[1]
    big = np.flatnonzero(flat >= 1 << 53)
    bits[big] = np.searchsorted(_POWERS, flat[big], side="right")
    width[:, :SPAN] = bits.reshape(rows, SPAN)
    # widest of the next c ids, for rising c, from two windows that are known already
    most, have = {1: width}, [1]
    for c in COUNTS[::-1][1:].tolist():
        a = max(x for x in have if 2 * x >= c)
        m = most[a].copy()
        np.maximum(m[:, :-(c - a)], most[a][:, c - a:], out=m[:, :-(c - a)])
        most[c] = m
        have.append(c)
    sel = np.full((rows, SPAN), 15, np.uint8)
    for s in range(14, -1, -1):
        np.copyto(sel, s, where=most[int(COUNTS[s])][:, :SPAN] <= WIDTHS[s])
    # walk all spans at once, from word to word
    length = np.full(rows, SPAN)
    length[-1] = n - SPAN * (rows - 1)
    head = np.zeros((rows, SPAN), bool)
    row, at = np.arange(rows), np.zeros(rows, np.int64)
    while len(row):
        head[row, at] = True
        at = at + COUNTS[sel[row, at]]
        on = at < length[row]
        row, at = row[on], at[on]
    r, p = np.nonzero(head)
    s = sel[r, p]
    extra = escaped.reshape(rows, SPAN)[r, p] & (s == 15)
    place = np.cumsum(1 + extra) - (1 + extra)
    words = np.zeros(int((1 + extra).sum()), np.uint64)
    for k in np.unique(s):
        i = np.flatnonzero(s == k)
        c, b = int(COUNTS[k]), int(WIDTHS[k])
        w = np.full(len(i), np.uint64(int(k) << 60))
        if b:
            vals = pad[r[i][:, None], p[i][:, None] + np.arange(c)]
            w |= np.bitwise_or.reduce(vals << (np.arange(c) * b).astype(np.uint64), axis=1)
        words[place[i]] = w
    words[place[extra] + 1] = ids[(r * SPAN + p)[extra]]
    first = place[np.searchsorted(r, np.arange(rows))]
    return words, first.astype(np.uint32)


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The n ids of :func:`encode`."""
    out = np.zeros(len(offsets) * SPAN, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    literal = np.zeros(len(words) + 1, bool)
    for i in np.flatnonzero((sel == 15) & ((words & np.uint64(_ESCAPE)) == _ESCAPE)).tolist():
        if not literal[i]:
            literal[i + 1] = True
    plain = np.flatnonzero(~literal[:-1])
    escape = literal[plain + 1]
    sel = sel[plain]
    count = COUNTS[sel]
    row = np.searchsorted(offsets, plain, side="right") - 1
    run = np.cumsum(count) - count
    pos = run - run[np.searchsorted(row, np.arange(len(offsets)))][row]
    for k in np.unique(sel):
        i = np.flatnonzero(sel == k)
        c, b = int(COUNTS[k]), int(WIDTHS[k])
        if not b:
            continue
        v = (words[plain[i]][:, None] >> (np.arange(c) * b).astype(np.uint64)) & np.uint64((1 << b) - 1)
        to = pos[i][:, None] + np.arange(c)
        ok = to < SPAN
        out[(row[i][:, None] * SPAN + to)[ok]] = v[ok]
    out[(row * SPAN + pos)[escape]] = words[plain[escape] + 1]
    return out[:n]


def write_token_files(spark: SparkSession, docs: DataFrame, path: str, name: str = "word_bpe_49k.json",
                      end_id: int = 2) -> None:
    """Encode every row of ``docs`` (null text: empty) and write its ids, ``end_id`` last, to
    ``path`` in ascending doc_id order (nulls first; rows that share a doc_id in any order).
    Documents are dealt to parts by ranges of doc_id; a block closes after ``BLOCK_IDS`` ids, at
    a document's end. Empty tables give an empty file set; other columns are not looked at."""
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        enc, part = encoder(name), TaskContext.get().partitionId()
        block, before, docs_in, lens_in, ids_in = 0, 0, [], [], []

        def flush():
            nonlocal block, before, docs_in, lens_in, ids_in
            ids = np.concatenate(ids_in)
            words, offsets = encode(ids)
            row = {"part": part, "block": block, "before": before, "n_ids": len(ids), "doc_ids": docs_in,
                   "lens": lens_in, "offsets": offsets.astype("<u4").tobytes(), "words": words.astype("<u8").tobytes()}
            block, before, docs_in, lens_in, ids_in = block + 1, before + len(ids), [], [], []
            return pa.RecordBatch.from_arrays(
                [pa.array([row["part"]], pa.int32()), pa.array([row["block"]], pa.int32()),
                 *[pa.array([row[k]], pa.int64()) for k in ("before", "n_ids")],
                 *[pa.array([row[k]], pa.list_(pa.int64())) for k in ("doc_ids", "lens")],
                 *[pa.array([row[k]], pa.binary()) for k in ("offsets", "words")]], names=list(row))

        held = 0
        for b in batches:
            ids, off = enc.ids(texts_of(b.column(1)), end_id)
            names, n, s = b.column(0).to_pylist(), np.diff(off), 0
            while s < len(names):
                e = min(len(names), int(np.searchsorted(off, off[s] + BLOCK_IDS - held)))
                e = max(e, s + 1)
                docs_in += names[s:e]
                lens_in += n[s:e].tolist()
                ids_in.append(ids[off[s]:off[e]])
                held += int(off[e] - off[s])
                s = e
                if held >= BLOCK_IDS:
                    yield flush()
                    held = 0
        if docs_in:
            yield flush()

    (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
     .repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id")
     .mapInArrow(run, BLOCKS).write.parquet(path))


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ``ids``, an array, if asked) of every document of
    a file set, from its blocks alone. ``start`` counts the ids of all documents before it."""
    prepare(spark)
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # one row per part: as many as the writer had partitions
    base = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids = decode(np.frombuffer(r["words"], "<u8"), np.frombuffer(r["offsets"], "<u4"), r["n_ids"])
                off = np.concatenate([[0], np.cumsum(r["lens"])]).astype(np.int64)
                small = ids.astype("<u4")
                cols = [pa.array(r["doc_ids"], pa.int64()), pa.array(off[:-1] + r["before"] + r["base"]),
                        pa.array(np.diff(off)),
                        pa.array([zlib.crc32(small[x:y].tobytes()) for x, y in zip(off, off[1:])], pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(cols)])

    return blocks.join(F.broadcast(base), "part").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<bigint>" if with_ids else ""))


def op2_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/prepforge-llm/tokens-{uuid.uuid4().hex}"
    write_token_files(spark, documents(spark, sf_dir), path)
    return read_token_files(spark, path)
