"""Operator 7: mixture-controlled packing by deficit round-robin over the sources' queues."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prepforge.llm.common import documents, encoder, materialize, prepare, running_sums, texts_of

LENGTH = 2048
#: Tokens of a window, over which the sources' proportions hold.
WINDOW = 16 * LENGTH
PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
         "offset long, source string")


def token_rows(spark: SparkSession, docs: DataFrame, name: str, end_id: int) -> DataFrame:
    """rid, doc_id, source, n, ids (little-endian uint16 if the vocabulary fits, else uint32)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name)
        kind = "<u2" if max(enc.tok.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        for b in batches:
            ids, off = enc.ids(texts_of(b.column(3)), end_id)
            raw = ids.astype(kind)
            at = (off * raw.itemsize).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(np.diff(off)),
                 pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(at.tobytes()),
                                                                         pa.py_buffer(raw.tobytes())]).cast(pa.binary())],
                names=["rid", "doc_id", "source", "n", "ids"])
    return docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"),
                       F.col("source").cast("string"), F.col("text").cast("string")) \
        .mapInArrow(run, "rid long, doc_id long, source string, n long, ids binary")


def plan_pieces(spark: SparkSession, rows: DataFrame, weights: dict | None, length: int, window: int) -> DataFrame:
    """(rid, pieces) for rows (rid, source, n): where each part of each row goes.

    Each source queues its rows in order; a row is served in parts of at most ``length``. In
    every window a source's deficit counter gains ``window`` times its target share and the
    parts at the head of its queue go out while the counter covers them; what is left is
    carried on. Since nothing but the counter delays a part, the one that ends at b in its
    queue goes out in window ceil(b / gain): the prefix sums of the queues say what a loop
    over windows would. The windows' parts, source after source, are then one stream that is
    cut every ``length``, so only the last sequence needs padding. Sources that run dry leave
    their windows to the others.
    """
    q = running_sums(spark, rows, ["source", "rid"], "n", "source", "packq")
    t = rows.groupBy("source").agg(F.sum("n").cast("double").alias("w"))
    if weights is not None:
        pairs = [(k, float(v)) for k, v in weights.items()]
        given = spark.createDataFrame(pairs, "_s string, _w double")
        t = t.join(given, t["source"].eqNullSafe(given["_s"]), "left").select(
            "source", F.coalesce("_w", F.lit(1.0)).alias("w"))
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.select(F.col("source").alias("_s"), (F.lit(float(window)) * F.col("w") / F.sum("w").over(all_rows)).alias("gain"),
                 F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).alias("turn"))
    parts = q.join(t, q["source"].eqNullSafe(t["_s"])).withColumn(
        "j", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / F.lit(length)))))
    parts = parts.withColumn("start", F.col("j") * length).withColumn(
        "size", F.least(F.lit(length).cast("long"), F.col("n") - F.col("start"))).withColumn(
        "place", F.col("before") + F.col("start")).withColumn(
        "round", F.ceil((F.col("place") + F.col("size")).cast("double") / F.col("gain")))
    stream = running_sums(spark, materialize(spark, parts.select(
        "rid", "round", "turn", "place", "start", "size"), "packparts"),
        ["round", "turn", "place"], "size", None, "packstream")
    first = F.least(F.col("size"), F.lit(length) - F.col("before") % length)
    seq = F.floor(F.col("before") / length)
    piece = lambda start, size, s, off: F.struct(
        start.alias("start"), size.alias("length"), s.cast("long").alias("sequence_id"), off.cast("long").alias("offset"))
    cut = F.array(piece(F.col("start"), first, seq, F.col("before") % length),
                  piece(F.col("start") + first, F.col("size") - first, seq + 1, F.lit(0)))
    return stream.select("rid", F.explode(cut).alias("p")).where("p.length > 0") \
        .groupBy("rid").agg(F.collect_list("p").alias("pieces"))


def pack(spark: SparkSession, docs: DataFrame, name: str = "word_bpe_49k.json", end_id: int = 1,
         weights: dict | None = None, length: int = LENGTH, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece of every row of ``docs``: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, source (and ``ids``, an array, if asked).

    Ids are the text's (null: empty) with ``end_id`` last. ``weights`` are target proportions
    by source (1 for those not named); without them each source's share of all tokens, so that
    every window has the mixture of the whole table. A null source is a queue of its own.
    Repeated rows are packed as often as they occur; other columns are not looked at; an empty
    table gives no rows. Tokens are written once to the shared folder, the plan is made from
    counts alone and joined back by row.
    """
    prepare(spark)
    rows = materialize(spark, token_rows(spark, docs, name, end_id), "packtokens")
    plan = plan_pieces(spark, rows.select("rid", "source", "n"), weights, length, window)
    joined = rows.join(plan, "rid").select("doc_id", "source", "n", "ids", "pieces")
    schema = PIECE + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                   "sequence_id", "offset", "source", *["ids"] * with_ids)}
            for doc_id, source, n, raw, pieces in zip(*[c.to_pylist() for c in b.columns]):
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                for p in sorted(pieces, key=lambda p: p["start"]):
                    own = ids[p["start"]:p["start"] + p["length"]]
                    out["doc_id"].append(doc_id)
                    out["source"].append(source)
                    out["doc_tokens"].append(n)
                    out["ids_crc32"].append(zlib.crc32(own.tobytes()))
                    for k in ("start", "length", "sequence_id", "offset"):
                        out[k].append(p[k])
                    if with_ids:
                        out["ids"].append(own.tolist())
            kinds = [pa.int64()] * 7 + [pa.string()] + [pa.list_(pa.int32())] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    return joined.mapInArrow(run, schema)


def sequences(spark: SparkSession, docs: DataFrame, pad_id: int = 0, length: int = LENGTH, **options) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, padded to ``length`` unless their
    length is a power of two."""
    p = pack(spark, docs, length=length, with_ids=True, **options)
    s = p.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("x")).select(
        "sequence_id", F.flatten(F.transform("x", lambda e: e["ids"])).alias("ids"))
    n = F.size("ids")
    return s.withColumn("ids", F.when(F.bit_count(n) == 1, F.col("ids")).otherwise(
        F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(length) - n))))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, documents(spark, sf_dir))
