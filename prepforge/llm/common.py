"""Shared pieces of the operators: scratch tables in the shared folder, running
sums over range partitions, connected components, word splitting and token ids."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from prepforge.session import ensure_checkpoint_dir

#: A word: a run of characters other than space, tab, line feed, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows in an Arrow batch; long documents make large batches at Spark's default of 10,000.
BATCH_ROWS = 1024
DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def prepare(spark: SparkSession) -> SparkSession:
    """Package on the workers, checkpoint folder set, Arrow batches of bounded size."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def materialize(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back: cuts
    the lineage and outlives executors, and every later reader sees the same rows."""
    path = f"{ensure_checkpoint_dir(spark)}/prepforge-llm/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._prepforge_path = path
    return out


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Delete a table of :func:`materialize` that nothing reads any more."""
    path = getattr(df, "_prepforge_path", None)
    if path:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def running_sums(spark: SparkSession, df: DataFrame, order: list[str], value: str,
                 group: str | None, tag: str) -> DataFrame:
    """``df`` with ``before``: the sum of ``value`` (long) over the rows that precede in
    ``order`` (within ``group`` when given; ``order`` must then start with it).

    Rows are range partitioned and sorted, each task adds up its own rows in one pass and
    the partition totals (partitions x groups in them) are added up by a window, so a hot
    group is spread over many tasks. ``df`` should be a cheap scan: the range partitioner
    samples it first. Nulls in ``order`` sort first; rows that tie on all of ``order``
    precede one another in any one order.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("part", T.IntegerType()),
                           T.StructField("local", T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, total, last = TaskContext.get().partitionId(), 0, None
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column(b.schema.get_field_index(value)).to_numpy(zero_copy_only=False).astype(np.int64)
            run = np.cumsum(v) - v
            if group is None:
                local = run + total
                total += int(v.sum())
            else:
                g = b.column(b.schema.get_field_index(group)).to_pylist()
                cut = [0, *(i for i in range(1, len(g)) if g[i] != g[i - 1])]
                local = np.empty(len(v), np.int64)
                for s, e in zip(cut, [*cut[1:], len(g)]):
                    if last is None or last[0] != g[s]:
                        total = 0
                    local[s:e] = run[s:e] - run[s] + total
                    total += int(v[s:e].sum())
                    last = (g[s],)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(local)],
                names=[*b.schema.names, "part", "local"])

    rows = materialize(spark, df.repartitionByRange(partitions(spark), *order)
                       .sortWithinPartitions(*order).mapInArrow(add, schema), tag)
    keys = ["part"] + ([group] if group else [])
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    if group:
        w = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy(*keys).agg(F.sum(value).alias("_s")).withColumn(
        "_base", F.coalesce(F.sum("_s").over(w), F.lit(0)))
    base = base.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_base")
    cond = [rows[k].eqNullSafe(base[f"_k{i}"]) for i, k in enumerate(keys)]
    return (rows.join(base, cond, "left").withColumn("before", F.col("local") + F.col("_base"))
            .drop("part", "local", "_base", *[f"_k{i}" for i in range(len(keys))]))


def connected_components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) for every end of ``links`` (a, b: long), component the least node.

    Alternates the large-star and small-star steps (Kiveris et al. 2014): each round sends
    every node's neighbours to its least one. A node of any degree is only reduced to a
    minimum and joined back, never collected. Links shrink to stars in a logarithmic number
    of rounds; each round is written to the shared folder and the one before deleted. Every round
    but the last lowers some node's neighbour, so the loop ends.
    """
    e = materialize(spark, links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    mark = None
    while True:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )).alias("x")).select("x.*").where("a <> b").distinct()
        nxt = materialize(spark, small, "cc")
        now = nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(spark, e)
        e = nxt
        if tuple(now) == mark:
            break
        mark = tuple(now)
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def texts_of(column: pa.Array) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def numbers(slots: dict[str, int], words: list[str]) -> np.ndarray:
    """The words' values in ``slots``, -1 where there is none."""
    return np.fromiter(map(slots.get, words, repeat(-1)), np.int64, len(words))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in one array, and the offsets of each text's words in it."""
    parts = pc.ascii_split_whitespace(texts)
    flat = parts.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    keep = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))]).astype(np.int64)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    return flat.filter(full), keep[offsets - offsets[0]]


def gather(pool: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The concatenation of pool[s : s + n] for each s, n."""
    total = int(lens.sum())
    if not total:
        return pool[:0]
    shift = np.repeat(starts - (np.cumsum(lens) - lens), lens)
    return pool[np.arange(total, dtype=np.int64) + shift]


#: Words of these letters alone keep their ids beside any mark, and in lower case (A-Z).
LETTERS = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]+$"
MARKS = ".,;:!?"


class Encoder:
    """Ids of whole texts from the tokenizers library, each distinct word encoded once.

    The vocabulary's pre-tokenizer drops white space, never joins across it, and parts letters from
    marks, so a text's ids are those of its words in turn, and those of letters and the marks after
    them in turn (the tests hold this against whole texts). Words are joined by a control character
    that is one id of its own and encoded together; words holding it are encoded alone. At ``limit``
    words, or ``most`` characters of them, those that came up in one batch alone are forgotten (all of
    them if that leaves over half).
    """

    def __init__(self, name: str, limit: int = 400_000, most: int = 16_000_000, mark: str = "\x01"):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(public_tokenizers.path(name))
        self.mark, self.limit, self.most = mark, limit, most
        self.mark_id, = self.tok.encode(mark, add_special_tokens=False).ids
        self.clear()

    def clear(self) -> None:
        self.slots: dict[str, int] = {"": 0}
        self.starts, self.lens = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.uint32)
        self.again = np.zeros(1, bool)  # came up again after the batch that taught it
        self.chars = 0

    def forget(self) -> None:
        """Keep the words that came up again."""
        keep = np.flatnonzero(self.again)
        if 2 * len(keep) > min(self.limit, len(self.slots)):
            return self.clear()
        names = list(self.slots)
        words = [names[i] for i in keep.tolist()]
        pool = gather(self.pool, self.starts[keep], self.lens[keep])
        lens = np.concatenate([[0], self.lens[keep]])
        self.clear()
        self.slots.update(zip(words, range(1, len(words) + 1)))
        self.pool, self.lens, self.starts = pool, lens, np.cumsum(lens) - lens
        self.again = np.zeros(len(lens), bool)
        self.chars = sum(map(len, words))

    def learn(self, plain: list[str], odd: list[str]) -> None:
        pieces, lens = [self.pool], [self.lens]
        alone = [w for w in odd if self.mark in w or len(w) > 1000]
        odd = [w for w in odd if self.mark not in w and len(w) <= 1000]
        for words, glue in ((plain, self.mark), (odd, f" {self.mark} ")):
            for i in range(0, len(words), 400):
                part = words[i:i + 400]
                ids = np.array(self.tok.encode_batch_fast([glue.join(part)], add_special_tokens=False)[0].ids, np.uint32)
                cut = np.flatnonzero(ids == self.mark_id)
                assert len(cut) == len(part) - 1
                pieces.append(ids[ids != self.mark_id])
                lens.append(np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1)
        for w in alone:
            ids = np.array(self.tok.encode(w, add_special_tokens=False).ids, np.uint32)
            pieces.append(ids)
            lens.append(np.array([len(ids)]))
        for w in (*plain, *odd, *alone):
            self.slots[w] = len(self.slots)
        self.chars += sum(map(len, plain)) + sum(map(len, odd)) + sum(map(len, alone))
        self.pool = np.concatenate(pieces)
        self.lens = np.concatenate(lens).astype(np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        self.again = np.concatenate([self.again, np.zeros(len(self.lens) - len(self.again), bool)])

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """Slots of words, new ones learned."""
        d = words.dictionary_encode()
        slot = numbers(self.slots, strings(d.dictionary))
        new = np.flatnonzero(slot < 0)
        self.again[slot[slot > 0]] = True
        if len(new):
            fresh = d.dictionary.take(pa.array(new))
            plain = pc.match_substring_regex(fresh, LETTERS)
            self.learn(strings(fresh.filter(plain)), strings(fresh.filter(pc.invert(plain))))
            slot[new] = numbers(self.slots, strings(fresh))
        return slot[d.indices.to_numpy()]

    def ids(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """uint32 ids of all texts, each followed by ``end``, and the texts' offsets."""
        words, off = split_words(texts)
        if len(self.slots) > self.limit or self.chars > self.most:
            self.forget()
        d = words.dictionary_encode()
        names = d.dictionary
        core = pc.utf8_rtrim(names, characters=MARKS)
        plain = pc.match_substring_regex(core, LETTERS)
        core = pc.if_else(plain, pc.ascii_lower(core), names)
        tail = np.flatnonzero(pc.less(pc.binary_length(core), pc.binary_length(names)).to_numpy(zero_copy_only=False))
        slot = np.zeros((len(names), 2), np.int64)
        if len(names):
            slot[:, 0] = self._numbers(core)
        if len(tail):
            pairs = zip(strings(names.take(pa.array(tail))), strings(core.take(pa.array(tail))))
            ends = pa.array([w[len(c):] for w, c in pairs])
            slot[tail, 1] = self._numbers(ends)
        # this batch's distinct words, letters and marks side by side
        pool = gather(self.pool, self.starts[slot.ravel()], self.lens[slot.ravel()])
        lens = self.lens[slot].sum(axis=1)
        starts = np.cumsum(lens) - lens
        at = d.indices.to_numpy()
        n = lens[at]
        run = np.concatenate([[0], np.cumsum(n)])
        ends = run[off] + np.arange(len(off))  # each text adds one id
        out = np.empty(int(ends[-1]), np.uint32)
        is_end = np.zeros(len(out), bool)
        is_end[ends[1:] - 1] = True
        out[is_end] = end
        out[~is_end] = gather(pool, starts[at], n)
        return out, ends


_KEPT: dict = {}


def kept(owner: tuple, make: Callable):
    """What ``make()`` returns, kept between a Python worker's tasks until another ``owner`` asks: a
    worker that Spark reuses holds one operator's memory at a time."""
    if owner not in _KEPT:
        _KEPT.clear()
        pa.default_memory_pool().release_unused()
        _KEPT[owner] = make()
    return _KEPT[owner]


def encoder(name: str) -> Encoder:
    return kept(("encoder", name), lambda: Encoder(name))


def packed(docs: DataFrame, **more: F.Column) -> DataFrame:
    """Each row of ``docs`` whole in one struct column ``row``, and the columns of ``more``: whatever
    names ``docs`` has, they clash with none of the operator's own."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in more.items()])


def arrow_map(df: DataFrame, fn: Callable, schema: str | T.StructType) -> DataFrame:
    return df.mapInArrow(fn, schema)


def crc_mod(col: str, m: int) -> F.Column:
    """crc32 of the value written as text, modulo m; a null counts as remainder 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(m)), F.lit(0))
