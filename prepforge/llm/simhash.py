"""Operator 6: SimHash near-duplicates, linked through the anchors of a covering code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepforge.llm.common import (
    connected_components, documents, materialize, packed, partitions, prepare, split_words, texts_of)

#: Words in a shingle and the most differing bits of a link (fixed values of the task).
SHINGLE, MAX_BITS = 3, 2
#: Generator polynomial of the perfect binary Golay code [23, 12]: x^11+x^10+x^6+x^5+x^4+x^2+1.
GOLAY, GOLAY_N, GOLAY_RADIUS = 0b110001110101, 23, 3


def shingle_hashes(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of each text's k-word shingles, and the texts' offsets in them."""
    from xxhash import xxh64_intdigest
    words, off = split_words(pc.ascii_lower(texts))
    n = np.diff(off)
    size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    # all words joined by single blanks: a shingle is a slice of it
    raw = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0]
    buf = raw.as_buffer().to_pybytes() if len(words) else b""
    start = np.cumsum(size + 1) - (size + 1)
    stop = start + size
    m = np.where(n == 0, 0, np.maximum(n - k + 1, 1))
    first = np.repeat(off[:-1] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
    last = np.minimum(first + k - 1, np.repeat(off[1:] - 1, m))
    h = np.fromiter((xxh64_intdigest(buf[a:b], 42) for a, b in
                     zip(start[first].tolist(), stop[last].tolist())), np.uint64, len(first))
    return h, np.concatenate([[0], np.cumsum(m)])


def _byte_lanes() -> np.ndarray:
    """For each byte value, its 8 bits as 8 counters of one byte in a uint64."""
    v = np.arange(256, dtype=np.uint64)
    out = np.zeros(256, np.uint64)
    for i in range(8):
        out |= ((v >> np.uint64(i)) & np.uint64(1)) << np.uint64(8 * i)
    return out


_LANES = _byte_lanes()


def fingerprints(texts: pa.Array, k: int = SHINGLE) -> np.ndarray:
    """uint64 SimHash of each text: a bit is 1 if set in over half its shingles' hashes."""
    h, off = shingle_hashes(texts, k)
    n = np.diff(off)
    out = np.zeros(len(n), np.uint64)
    if not len(h):
        return out
    # runs of at most 255 hashes of one text, so that a one-byte counter can't overflow
    runs = -(-n // 255)
    doc = np.repeat(np.arange(len(n)), runs)
    begin = off[:-1][doc] + 255 * (np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs))
    full = np.flatnonzero(n)
    at = (np.cumsum(runs) - runs)[full]
    raw = h.view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        lanes = np.add.reduceat(_LANES[raw[:, byte]], begin)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), at, axis=0)
        bits = 2 * counts > n[full][:, None]
        out[full] |= np.packbits(bits, axis=1, bitorder="little")[:, 0].astype(np.uint64) << np.uint64(8 * byte)
    return out


def fingerprint_rows(docs: DataFrame, k: int = SHINGLE, keys: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp: long) and the long columns ``keys`` of every row; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(fingerprints(texts_of(b.column(1)), k).view(np.int64)), *b.columns[2:]],
                names=["doc_id", "fp", *keys])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *keys) \
        .mapInArrow(run, "doc_id long, fp long" + "".join(f", {c} long" for c in keys))


def _syndromes(v: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words divided by the generator."""
    v = v.copy()
    for bit in range(GOLAY_N - 1, 10, -1):
        v = np.where((v >> bit) & 1 == 1, v ^ (GOLAY << (bit - 11)), v)
    return v


class Anchors:
    """The covering code: two Golay words on bits 0-22 and 23-45; the other 18 bits are free.

    Golay's code is perfect: every 23-bit word lies within 3 of exactly one codeword. A
    fingerprint's home is that pair of codewords. Another one that differs in at most t bits
    is within 3 + a of the first codeword and 3 + b of the second with a + b <= t, so its
    anchors are all pairs at such distances. ``near[s]`` lists the differences from a word of
    syndrome s to the codewords within 3 + t, ``over[s]`` their distances above 3.
    """

    def __init__(self, t: int):
        words = np.array([0], np.int64)
        levels = [words]
        for _ in range(GOLAY_RADIUS + t):
            words = np.unique((words[:, None] ^ (1 << np.arange(GOLAY_N, dtype=np.int64))).ravel())
            levels.append(words)
        e = np.unique(np.concatenate(levels))
        weight = np.bitwise_count(e.astype(np.uint64)).astype(np.int64)
        s = _syndromes(e)
        order = np.lexsort((e, weight, s))
        self.e, self.over, s = e[order], np.maximum(weight[order] - GOLAY_RADIUS, 0), s[order]
        self.at = np.searchsorted(s, np.arange(2049))
        self.t = t

    def home(self, fp: np.ndarray) -> np.ndarray:
        out = np.zeros(len(fp), np.int64)
        for shift in (0, GOLAY_N):
            v = ((fp >> np.uint64(shift)) & np.uint64((1 << GOLAY_N) - 1)).astype(np.int64)
            out |= (v ^ self.e[self.at[_syndromes(v)]]) << shift
        return out

    def covering(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, anchor) of every anchor that each fingerprint is compared at."""
        half = []
        for shift in (0, GOLAY_N):
            v = ((fp >> np.uint64(shift)) & np.uint64((1 << GOLAY_N) - 1)).astype(np.int64)
            s = _syndromes(v)
            n = self.at[s + 1] - self.at[s]
            idx = np.repeat(self.at[s] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            row = np.repeat(np.arange(len(fp)), n)
            half.append((row, self.over[idx], (v[row] ^ self.e[idx]) << shift, n))
        (r1, o1, c1, _), (_, o2, c2, n2) = half
        first = np.cumsum(n2) - n2
        m = n2[r1]
        left = np.repeat(np.arange(len(r1)), m)
        right = np.repeat(first[r1] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
        ok = o1[left] + o2[right] <= self.t
        left, right = left[ok], right[ok]
        return r1[left], c1[left] | c2[right]


def near_links(spark: SparkSession, fps: DataFrame, t: int = MAX_BITS) -> DataFrame:
    """(a, b) with a < b of distinct fingerprints (column ``fp``) that differ in 1 to t bits.

    Each pair meets at the home of either one: the join compares, per anchor, the fingerprints
    at home there with those replicated to it. A fingerprint has at most 2,080 others within
    two bits, so the links stay in proportion to the fingerprints. Spark takes either side for as large as the
    fingerprints, though one has some 61 rows for each: the hint keeps it from being broadcast.
    """
    anchors = Anchors(t)

    def home(batches):
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(anchors.home(fp)), b.column(0)], names=["anchor", "a"])

    def spread(batches):
        for b in batches:
            raw = b.column(0).to_numpy()
            for i in range(0, len(raw), 4096):
                row, anchor = anchors.covering(raw[i:i + 4096].view(np.uint64))
                for j in range(0, len(row), 65536):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor[j:j + 65536]), pa.array(raw[i:i + 4096][row[j:j + 65536]])],
                        names=["anchor", "b"])

    h = fps.select("fp").mapInArrow(home, "anchor long, a long")
    r = fps.select("fp").mapInArrow(spread, "anchor long, b long")
    return h.join(r.hint("merge"), (h["anchor"] == r["anchor"]) & (F.col("a") < F.col("b"))
                  & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= t)).select("a", "b").distinct()


def fingerprint_parts(spark: SparkSession, rows: DataFrame, t: int) -> DataFrame:
    """(fp, least doc_id, part) of the distinct fingerprints of ``rows``; ``part`` is the least
    fingerprint of the component, unlike its least doc_id never shared by two components."""
    nodes = materialize(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simnodes")
    links = near_links(spark, nodes.repartition(partitions(spark), "fp"), t)
    parts = connected_components(spark, links)
    return nodes.join(parts, nodes["fp"] == parts["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("part"))


def simhash_groups(spark: SparkSession, docs: DataFrame, k: int = SHINGLE, t: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id) of every row of ``docs``.

    Texts are lower-cased (A-Z) and cut into words; shingles of ``k`` words are hashed and
    summed to a 64-bit fingerprint. Equal fingerprints are one node; nodes within ``t`` bits
    are linked and the least doc_id reachable names the component. Null and empty texts have
    fingerprint zero and link like any other. Repeated rows are all returned; a null doc_id
    is returned with its group's least id (null if the group has no other). Empty tables give
    no rows; other columns are not looked at.
    """
    prepare(spark)
    rows = materialize(spark, fingerprint_rows(docs, k), "simhash")
    named = fingerprint_parts(spark, rows, t)
    ids = named.groupBy("part").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "part").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each_group(spark: SparkSession, docs: DataFrame, k: int = SHINGLE, t: int = MAX_BITS,
                      one_per_id: bool = False) -> DataFrame:
    """One row of ``docs`` for each component: the one of the least doc_id (nulls last), on a tie
    of the least row key. The key is a 128-bit hash of the whole row, so that rows with one doc_id
    and different texts are told apart and rows that share a key are equal in every column. All
    columns come through, whatever their names.
    ``one_per_id``: of the rows kept that share a doc_id (not null) only the least key's stays."""
    prepare(spark)
    whole = [x for c in docs.columns for x in (F.col(c).isNull(), F.col(c))]
    keyed = packed(docs, doc_id=docs["doc_id"], text=docs["text"], _k1=F.xxhash64(F.lit(1), *whole), _k2=F.xxhash64(F.lit(2), *whole))
    rows = materialize(spark, fingerprint_rows(keyed, k, ("_k1", "_k2")), "simhash")
    parts = fingerprint_parts(spark, rows, t).select("fp", "part")
    keep = rows.join(parts, "fp").groupBy("part").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "_k1", "_k2")).alias("x")).select("x.*")
    if one_per_id:
        first = keep.where("not none").groupBy("doc_id").agg(F.min(F.struct("_k1", "_k2")).alias("x")).select("x.*")
        keep = first.unionByName(keep.where("none").select("_k1", "_k2"))
    return keyed.select("row", "_k1", "_k2").join(keep.select("_k1", "_k2"), ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, k: int = SHINGLE, t: int = MAX_BITS) -> DataFrame:
    """As :func:`one_of_each_group`, for tables whose doc_id names a document: no two rows of the
    result share one (nulls apart)."""
    return one_of_each_group(spark, docs, k, t, one_per_id=True)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(spark, documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")
