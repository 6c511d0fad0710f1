"""Operator 3: a hierarchical Pitman-Yor language model of words.

Each context (the word before, hashed to one of ``CONTEXTS`` restaurants) is a Chinese restaurant
whose new tables are customers of one parent restaurant, the words without context; the parent's
new tables draw from all words evenly, one unseen word included. Gibbs sweeps seat every customer
of a dish in a restaurant anew given the tables of the rest; the predictive probabilities of the
kept sweeps are averaged.

How it is spread out. Documents are read in units; a unit's word pairs are dealt to buckets by the
word (by word and context if the word is frequent, so that no bucket holds a frequent word alone)
together with the documents that they stand in. A bucket then knows all counts of its words, seats
their customers, and adds up its share of each document's score; what buckets share are numbers of
a fixed size: tables and customers by context, and totals. A sweep reads the buckets' counts, replays
the sweeps before it from their seeds and returns those numbers, so no seating is stored. Within a
sweep, buckets see each other's tables as of the sweep before. Customers beyond the 64th of a pair
are seated in runs of a sixteenth of those present, with one draw of the new tables of a run.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepforge.llm.common import (
    crc_mod, documents, materialize, partitions, prepare, split_words, strings, texts_of)

CONTEXTS = 1 << 16
#: Words of a unit of documents.
UNIT = 1_000_000
#: Sweeps, and how many of the first are not averaged.
SWEEPS, BURN = 3, 1
#: Concentrations of the context restaurants and of their parent.
THETA, THETA_0 = 5.0, 50.0
SEED = 17
PIECE = 1 << 12


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned integers or floats, each in its narrowest type, compressed."""
    import zstandard
    out = []
    for a in arrays:
        a = np.asarray(a)
        if a.dtype.kind != "f":
            top = int(a.max(initial=0))
            a = a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)
        out += [struct.pack("<cBQ", a.dtype.kind.encode(), a.itemsize, len(a)), a.tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def unpack(data: bytes) -> list[np.ndarray]:
    import zstandard
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        kind, size, n = struct.unpack_from("<cBQ", raw, at)
        at += 10
        out.append(np.frombuffer(raw, np.dtype(f"<{kind.decode()}{size}"), n, at))
        at += n * size
    return out


def word_hash(w: bytes) -> int:
    from xxhash import xxh64_intdigest
    return xxh64_intdigest(w, 1)


END, START = word_hash(b""), word_hash(b"\n")  # no word is empty or holds a line feed


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, context, text) of every token, an end after each text's words."""
    words, off = split_words(pc.ascii_lower(texts))
    d = words.dictionary_encode()
    own = np.array([word_hash(w.encode()) for w in strings(d.dictionary)], np.uint64)
    ends = off[1:] + np.arange(1, len(off))
    h = np.empty(len(words) + len(off) - 1, np.uint64)
    is_end = np.zeros(len(h), bool)
    is_end[ends - 1] = True
    h[is_end] = END
    if len(own):
        h[~is_end] = own[d.indices.to_numpy()]
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[np.concatenate([[0], ends[:-1]])[:len(off) - 1]] = START
    return h, (before >> np.uint64(48)).astype(np.int64) % CONTEXTS, np.repeat(np.arange(len(off) - 1), np.diff(off) + 1)


def bucket_of(h: np.ndarray, ctx: np.ndarray, n: int, hot: np.ndarray) -> np.ndarray:
    spread = np.where(np.isin(h, hot), ctx * 40503 % 65521, 0)
    return ((h % np.uint64(n)).astype(np.int64) + spread) % n


def unit_payloads(h, ctx, doc, n_docs, n_train, buckets, hot) -> Iterator[tuple[int, bytes]]:
    """(bucket, payload) of a unit: words, pairs by word, contexts, documents by pair, documents
    (the first ``n_train`` are trained on) and counts."""
    words, inv = np.unique(h, return_inverse=True)
    key, tf = np.unique(((inv.astype(np.int64) << 16) | ctx) * n_docs + doc, return_counts=True)
    pair, doc = key // n_docs, key % n_docs
    where = bucket_of(words[pair >> 16], pair & 0xFFFF, buckets, hot)
    order = np.argsort(where, kind="stable")
    cut = np.searchsorted(where[order], np.arange(buckets + 1))
    for b in range(buckets):
        i = order[cut[b]:cut[b + 1]]
        if len(i):
            p, n_inc = np.unique(pair[i], return_counts=True)
            w, n_pairs = np.unique(p >> 16, return_counts=True)
            yield b, pack(words[w], n_pairs, p & 0xFFFF, n_inc, doc[i], tf[i], np.array([n_docs, n_train]))


def merge(units: list[tuple[int, bytes]], hot: np.ndarray) -> tuple[bytes, list[tuple[int, bytes]]]:
    """A bucket's counts (pairs by word, contexts, trained counts, numbers of its frequent words in
    ``hot`` or its length) and, for each unit, the bucket's pairs in it with documents and counts."""
    parts = [(u, unpack(x)) for u, x in units]
    words, inv = np.unique(np.concatenate([p[0] for _, p in parts]), return_inverse=True)
    keys, counts, at = [], [], 0
    for _, (w, n_pairs, ctx, n_inc, doc, tf, (n_docs, n_train)) in parts:
        keys.append((np.repeat(inv[at:at + len(w)].astype(np.int64), n_pairs) << 16) | ctx)
        at += len(w)
        first = np.cumsum(n_inc, dtype=np.int64) - n_inc
        counts.append(np.add.reduceat(tf.astype(np.int64) * (doc < n_train), first))
    pairs, index = np.unique(np.concatenate(keys), return_inverse=True)
    c = np.bincount(index, np.concatenate(counts), len(pairs)).astype(np.int64)
    n_pairs = np.bincount(pairs >> 16, minlength=len(words))
    slot = np.where(np.isin(words, hot), np.searchsorted(hot, words), len(hot)) if len(hot) else np.zeros(len(words), np.int64)
    out, at = [], 0
    for (u, (_, _, _, n_inc, doc, tf, (n_docs, n_train))), k in zip(parts, keys):
        own = index[at:at + len(k)]
        at += len(k)
        out.append((u, pack(np.diff(own, prepend=0), n_inc, doc, tf, np.array([n_docs]))))
    return pack(n_pairs, pairs & 0xFFFF, c, slot), out


def seat(c: np.ndarray, opening: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables of dishes with ``c`` customers each, seated one after the other: a customer opens a
    table with weight ``opening``, or joins one of t with weight (customers so far - discount t)."""
    t = (c > 0).astype(np.float64)
    n = 1
    live = np.flatnonzero(c > 1)
    while len(live):
        run = 1 if n < 64 else n // 16
        m = np.minimum(run, c[live] - n)
        join = n - discount * t[live]
        new = opening[live] / (opening[live] + join)
        t[live] += rng.binomial(m, new) if run > 1 else rng.random(len(live)) < new
        n += run
        live = live[c[live] > n]
    return t


class Bucket:
    """One bucket's counts and the replay of its sweeps."""

    def __init__(self, number: int, data: bytes, model: dict):
        n_pairs, ctx, c, slot = unpack(data)
        self.number, self.model = number, model
        self.ctx, self.c = ctx.astype(np.int64), c.astype(np.int64)
        self.dish = np.repeat(np.arange(len(n_pairs)), n_pairs)
        self.n = len(n_pairs)
        self.slot = slot.astype(np.int64)
        self.hot = self.slot < model["n_hot"]
        self.own_count = np.bincount(self.dish, self.c, self.n)

    def parent(self, customers, tables, state) -> np.ndarray:
        """The parent's probability of each dish, given the totals of ``state``."""
        customers, tables = customers.copy(), tables.copy()
        customers[self.hot], tables[self.hot] = state["hot"][0][self.slot[self.hot]], state["hot"][1][self.slot[self.hot]]
        m = self.model
        return ((np.maximum(customers - m["d0"] * tables, 0) + (THETA_0 + m["d0"] * state["tables"]) / (m["types"] + 1))
                / (THETA_0 + state["customers"]))

    def start(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One table for each dish in each restaurant."""
        t = (self.c > 0).astype(np.float64)
        customers = np.bincount(self.dish, t, self.n)
        return t, customers, (customers > 0).astype(np.float64)

    def sweeps(self, states: list[dict]):
        """The seating before and after each sweep: tables by pair, customers and tables in the parent."""
        t, customers, tables = self.start()
        yield t, customers, tables
        m = self.model
        for s, state in enumerate(states):
            rng = np.random.default_rng([SEED, self.number, s])
            p0 = self.parent(customers, tables, state)
            others = np.maximum(state["by_context"][self.ctx] - t, 0)
            t = seat(self.c, (THETA + m["d1"] * others) * p0[self.dish], m["d1"], rng)
            customers = np.bincount(self.dish, t, self.n)
            opening = np.full(self.n, (THETA_0 + m["d0"] * state["tables"]) / (m["types"] + 1))
            tables = np.where(self.hot, 0, seat(customers.astype(np.int64), opening, m["d0"], rng))
            yield t, customers, tables

    def totals(self, seating) -> list[tuple[int, np.ndarray]]:
        """Pieces to be summed over the buckets: tables and customers by context, totals, hot dishes."""
        t, customers, tables = seating
        by = np.bincount(self.ctx, t, CONTEXTS)
        cu = np.bincount(self.ctx, self.c, CONTEXTS)
        hot = np.zeros((2, self.model["n_hot"]))
        np.add.at(hot[0], self.slot[self.hot], customers[self.hot])
        np.add.at(hot[1], self.slot[self.hot], self.own_count[self.hot])
        rest = ~self.hot
        ones = [(self.c == 1).sum(), (self.c == 2).sum(), (customers[rest] == 1).sum(), (customers[rest] == 2).sum()]
        scalars = np.array([customers[rest].sum(), tables[rest].sum(), self.c.sum(), (self.own_count[rest] > 0).sum(), *ones], float)
        out = [(i, np.concatenate([by[i * PIECE:(i + 1) * PIECE], cu[i * PIECE:(i + 1) * PIECE]])) for i in range(CONTEXTS // PIECE)]
        return [*out, (-1, scalars), (-2, hot.ravel())]

    def log_probs(self, states: list[dict]) -> np.ndarray:
        """log10 of each pair's predictive probability, averaged over the kept sweeps. ``states``
        holds the totals before each sweep and, last, after the last one."""
        m, total = self.model, np.zeros(len(self.c))
        for s, (t, customers, tables) in enumerate(self.sweeps(states[:-1])):
            if s <= BURN:
                continue
            p0 = self.parent(customers, tables, states[s])[self.dish]
            cu, tu = m["by_context"][self.ctx], states[s]["by_context"][self.ctx]
            total += (np.maximum(self.c - m["d1"] * t, 0) + (THETA + m["d1"] * tu) * p0) / (THETA + cu)
        return np.log10(total / (SWEEPS - BURN))


def read_buckets(spark: SparkSession, docs: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """The table of buckets: rows (bucket, counts, inc) and rows of units (unit, doc_ids, n_tokens,
    n_train; bucket -1), from rows (doc_id, held_out, text)."""
    raw = "unit long, bucket int, payload binary, doc_ids array<bigint>, n_tokens array<bigint>, n_train int"
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32()]
    names = ["unit", "bucket", "payload", "doc_ids", "n_tokens", "n_train"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        unit, hold = TaskContext.get().partitionId() << 32, []

        def flush():
            nonlocal unit, hold
            ids = [i for x in hold for i in x[0]]
            held = np.concatenate([x[1] for x in hold])
            h, ctx = np.concatenate([x[2] for x in hold]), np.concatenate([x[3] for x in hold])
            base = np.cumsum([0, *(len(x[0]) for x in hold)])
            doc = np.concatenate([x[4] + b for x, b in zip(hold, base)])
            order = np.argsort(held, kind="stable")  # those trained on come first
            rank = np.empty(len(ids), np.int64)
            rank[order] = np.arange(len(ids))
            n_train = int((~held).sum())
            for b, payload in unit_payloads(h, ctx, rank[doc], len(ids), n_train, buckets, hot):
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(
                    (unit, b, payload, None, None, None), kinds)], names=names)
            n = np.bincount(rank[doc], minlength=len(ids))
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(
                (unit, -1 - unit % buckets, None, [ids[i] for i in order], n.tolist(), n_train), kinds)], names=names)
            unit, hold = unit + 1, []

        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            h, ctx, doc = tokens(texts_of(b.column(2)))
            hold.append((b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False).astype(bool), h, ctx, doc))
            size += len(h)
            if size >= UNIT:
                yield from flush()
                size = 0
        if hold:
            yield from flush()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(bucket, unit=None, doc_ids=None, n_tokens=None, n_train=None, counts=None, inc=None):
            return pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([unit], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                 pa.array([n_tokens], pa.list_(pa.int64())), pa.array([n_train], pa.int32()), pa.array([counts], pa.binary()),
                 pa.array([inc], pa.list_(pa.struct([("unit", pa.int64()), ("data", pa.binary())])))],
                names=["bucket", "unit", "doc_ids", "n_tokens", "n_train", "counts", "inc"])

        def close(bucket, units):
            counts, inc = merge(units, hot)
            return row(bucket, counts=counts, inc=[{"unit": u, "data": d} for u, d in inc])

        at, units = None, []
        for b in batches:
            for unit, bucket, payload, doc_ids, n_tokens, n_train in zip(*[c.to_pylist() for c in b.columns]):
                if bucket < 0:
                    yield row(-1, unit, doc_ids, n_tokens, n_train)
                    continue
                if bucket != at:
                    if units:
                        yield close(at, units)
                    at, units = bucket, []
                units.append((unit, payload))
        if units:
            yield close(at, units)

    return materialize(spark, docs.mapInArrow(make, raw).repartition(buckets, "bucket").sortWithinPartitions("bucket", "unit")
                       .mapInArrow(gather, "bucket int, unit long, doc_ids array<bigint>, n_tokens array<bigint>, "
                                           "n_train int, counts binary, inc array<struct<unit:bigint,data:binary>>"), "lm")


def frequent_words(spark: SparkSession, docs: DataFrame, buckets: int) -> np.ndarray:
    """Hashes of words that hold a large part of a bucket, by a look at one document in 64; they
    only decide where words are counted."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, _, _ = tokens(texts_of(b.column(2)))
            if len(h):
                u, n = np.unique(h, return_counts=True)
                big = n * 8 * buckets >= len(h)
                yield pa.RecordBatch.from_arrays([pa.array(np.append(u[big], 0).view(np.int64)),
                                                  pa.array(np.append(n[big], len(h)).astype(np.int64))], names=["h", "n"])

    seen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(64)) == 0).mapInArrow(count, "h long, n long") \
        .groupBy("h").agg(F.sum("n").alias("n"))
    total = seen.where("h = 0").select(F.col("n").alias("total"))
    rows = seen.where("h <> 0").join(F.broadcast(total), F.col("n") * 2 * buckets >= F.col("total")).select("h").collect()
    return np.sort(np.array([r["h"] for r in rows], np.int64).view(np.uint64))


def summed(spark: SparkSession, table: DataFrame, model: dict, states: list[dict]) -> dict[int, np.ndarray]:
    """The buckets' :meth:`Bucket.totals` after the sweeps that ``states`` precede, added up."""
    shared = spark.sparkContext.broadcast((model, states))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, states = shared.value
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for number, data in zip(*[c.to_pylist() for c in b.columns]):
                own = Bucket(number, data, model)
                for seating in own.sweeps(states):
                    pass
                for k, v in own.totals(seating):
                    total[k] = total[k] + v if k in total else v
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                          pa.array([pack(v) for v in total.values()], pa.binary())], names=["k", "v"])

    def add(pdf):
        import pandas as pd
        return pd.DataFrame({"k": [pdf["k"][0]], "v": [pack(sum(unpack(x)[0] for x in pdf["v"]))]})

    schema = "k int, v binary"
    rows = table.where("bucket >= 0").select("bucket", "counts").mapInArrow(run, schema).groupBy("k").applyInPandas(add, schema).collect()
    return {r["k"]: unpack(r["v"])[0] for r in rows}


def state_of(total: dict[int, np.ndarray], model: dict, rng) -> dict:
    """The totals that a sweep starts from; the frequent words' tables in the parent are drawn here."""
    scalars, hot = total[-1], total[-2].reshape(2, -1)
    by = np.concatenate([total[i][:PIECE] for i in range(CONTEXTS // PIECE)])
    tables = np.zeros(hot.shape[1])
    if len(tables):
        opening = (THETA_0 + model.get("d0", 0.5) * scalars[1]) / (model.get("types", 1) + 1)
        tables = seat(hot[0].astype(np.int64), np.full(len(tables), opening), model.get("d0", 0.5), rng)
    return {"by_context": by, "customers": float(scalars[0] + hot[0].sum()), "tables": float(scalars[1] + tables.sum()),
            "hot": np.stack([hot[0], tables])}


def fit(spark: SparkSession, table: DataFrame, n_hot: int) -> tuple[dict, list[dict]]:
    """(model, the totals before each sweep and after the last). The discounts come from how many
    pairs (and words of the parent) have one and two customers, n1 / (n1 + 2 n2)."""
    total = summed(spark, table, {"n_hot": n_hot}, [])
    if not total:
        return {"n_hot": n_hot, "train_tokens": 0, "types": 0}, []
    s, hot = total[-1], total[-2].reshape(2, -1)
    cut = lambda a, b: float(np.clip(a / max(a + 2 * b, 1), 0.05, 0.95))
    model = {"n_hot": n_hot, "train_tokens": int(s[2]), "types": int(s[3] + (hot[1] > 0).sum()), "d1": cut(s[4], s[5]),
             "d0": cut(s[6], s[7]), "hot_counts": hot[1],
             "by_context": np.concatenate([total[i][PIECE:] for i in range(CONTEXTS // PIECE)])}
    states = [state_of(total, model, np.random.default_rng([SEED, 0]))]
    for i in range(SWEEPS):
        states.append(state_of(summed(spark, table, model, states), model, np.random.default_rng([SEED, 1 + i])))
    return model, states


def score_texts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of rows (doc_id,
    held_out, text). The model learns from the rows that are not held out; ``score`` is its log10
    probability of the whole text, ``base_score`` that of smoothed word counts.

    Texts are lower-cased (A-Z) and cut at white space; an end follows each text's words, so null
    and empty texts are one token. A null held_out counts as false. Repeated rows and null ids are
    each returned; other columns are not looked at; an empty table gives no rows. With nothing to
    learn from, the one unseen word has probability one and both scores are 0.
    """
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("held_out", F.lit(False)).alias("held_out"), F.col("text").cast("string"))
    buckets = partitions(spark)
    hot = frequent_words(spark, docs, buckets)
    table = read_buckets(spark, docs, buckets, hot)
    model, states = fit(spark, table, len(hot))
    shared = spark.sparkContext.broadcast((model, states))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, states = shared.value
        for b in batches:
            for number, data, inc in zip(*[c.to_pylist() for c in b.columns]):
                own = Bucket(number, data, model)
                lp = own.log_probs(states)
                c = own.own_count.copy()
                c[own.hot] = model["hot_counts"][own.slot[own.hot]]
                base = np.log10((c + 0.5) / (model["train_tokens"] + 0.5 * (model["types"] + 1)))[own.dish]
                known = (c > 0)[own.dish]
                for x in inc:
                    step, n_inc, doc, tf, (n_docs,) = unpack(x["data"])
                    p = np.repeat(np.cumsum(step, dtype=np.int64), n_inc)
                    sums = [np.bincount(doc, tf * v[p], n_docs) for v in (lp, base, known)]
                    some = np.flatnonzero(np.bincount(doc, minlength=n_docs))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x["unit"]]), pa.array([pack(some, sums[0][some], sums[1][some],
                                                               sums[2][some].astype(np.int64))], pa.binary())], names=["unit", "data"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(meta, parts):
            ids, n, n_train = meta
            out = np.zeros((3, len(ids)))
            for x in parts:
                some, *v = unpack(x)
                for k in range(3):
                    out[k, some] += v[k]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.arange(len(ids)) >= n_train), pa.array(n, pa.int64()),
                 pa.array(out[2].astype(np.int64)), pa.array(np.full(len(ids), model["train_tokens"], np.int64)),
                 pa.array(out[1]), pa.array(out[0])],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        at, meta, parts = None, None, []
        for b in batches:
            for unit, data, ids, n, n_train in zip(*[c.to_pylist() for c in b.columns]):
                if unit != at:
                    if meta:
                        yield close(meta, parts)
                    at, meta, parts = unit, None, []
                if data is None:
                    meta = (ids, n, n_train)
                else:
                    parts.append(data)
        if meta:
            yield close(meta, parts)

    empty = F.lit(None)
    units = table.where("bucket < 0").select("unit", empty.cast("binary").alias("data"), "doc_ids", "n_tokens", "n_train")
    if model["train_tokens"] == 0:
        return units.select(F.explode(F.arrays_zip("doc_ids", "n_tokens")).alias("x"), "n_train").select(
            "x.doc_ids", F.lit(True).alias("held_out"), "x.n_tokens", F.lit(0).cast("long").alias("n_known"),
            F.lit(0).cast("long").alias("train_tokens"), F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score")) \
            .withColumnRenamed("doc_ids", "doc_id")
    sums = table.where("bucket >= 0").select("bucket", "counts", "inc").mapInArrow(run, "unit long, data binary")
    sums = sums.select("unit", "data", *[empty.cast(units.schema[c].dataType).alias(c) for c in ("doc_ids", "n_tokens", "n_train")])
    return units.unionByName(sums).repartition(buckets, "unit").sortWithinPartitions("unit", F.col("data").isNotNull()).mapInArrow(
        assemble, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op3_hpylm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(spark, documents(spark, sf_dir).withColumn("held_out", crc_mod("doc_id", 5) == 1))
