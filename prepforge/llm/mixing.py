"""Operator 8: mix sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prepforge.llm.common import WORD, documents, materialize, packed, prepare, running_sums

#: Weights of the sources in code-point order, repeated (fixed values of the task).
WEIGHTS = (5, 2, 1)
#: No source is taken more often than so many times.
MOST = 3


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Targets share the sum of all sizes by weight. A source is held at ``most`` times its
    size and what it leaves goes to the others by weight until none is above its bound.
    With the sources in order of bound / weight, the share per unit of weight after the
    first k are held, (all - bounds held) / (weights left), rises until the right k and
    falls after it, so its maximum is the answer: no loop. One row per source is sorted.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (n % len(weights) + 1).cast("int"))
    s = s.withColumn("w", w).withColumn("bound", F.lit(most) * F.col("source_size"))
    by = Window.orderBy(F.col("bound") / F.col("w"), F.col("source").asc_nulls_last())
    held = by.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(whole)
                               - F.coalesce(F.sum("bound").over(held), F.lit(0))).cast("double")
                     / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(held), F.lit(0.0))))
    return s.withColumn("level", F.max("level").over(whole)).select(
        "source", "source_size",
        F.least(F.col("bound").cast("double"), F.col("w") * F.col("level")).alias("target"))


def text_key(col: str) -> F.Column:
    """A hash of the text that tells a null from an empty one."""
    return F.xxhash64(F.col(col).isNull(), F.col(col))


def systematic_copies(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, source, text_hash, size, source_size, target, copies, taken.

    ``size`` counts words (null text: 0). Every document of a source expects the same number
    of copies, target / source_size. The documents of a source are put in order of size and
    doc_id, expected copies are added up along that order, one offset drawn from the source's
    name shifts the sums, and a copy goes out for each whole number that is crossed. The order
    by size keeps the words taken within about one document of the target. Reruns agree;
    documents that tie on source, size, doc_id and text may swap copies. Nulls: a null source
    is a source of its own, after all others; empty tables give no rows; a source without
    words has target 0 and takes nothing. Other columns of ``docs`` are not looked at.
    """
    prepare(spark)
    sized = materialize(spark, docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        text_key("text").alias("text_hash")), "mix")
    ranked = running_sums(spark, sized.withColumn("one", F.lit(1).cast("long")),
                          ["source", "size", "doc_id", "text_hash"], "one", "source", "mixrank")
    t = source_targets(sized, weights, most).withColumnRenamed("source", "_source")
    t = t.withColumn("rate", F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0)))
    t = t.withColumn("u", F.conv(F.substring(F.md5(F.coalesce(F.col("_source"), F.lit("(null)")).cast("binary")), 1, 8),
                                 16, 10).cast("double") / F.lit(4294967296.0))
    out = ranked.join(t, ranked["source"].eqNullSafe(t["_source"])).withColumn(
        "copies", F.floor((F.col("before") + 1) * F.col("rate") + F.col("u"))
        - F.floor(F.col("before") * F.col("rate") + F.col("u")))
    return out.select("doc_id", "source", "text_hash", "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


def mix(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`systematic_copies` says. Rows that agree
    on doc_id, source and text (a null is no empty text) are one row with the sum of their copies. All
    columns come through, whatever their names."""
    keys = ["doc_id", "source", "text_hash"]
    n = systematic_copies(spark, docs, weights, most).groupBy(*keys).agg(F.sum("copies").alias("_n")) \
        .where("_n > 0").select("_n", *[F.col(k).alias(f"_{k}") for k in keys])
    d = packed(docs, id=F.col("doc_id").cast("long"), src=F.col("source").cast("string"), h=text_key("text")).dropDuplicates(["id", "src", "h"])
    cond = d["id"].eqNullSafe(n["_doc_id"]) & d["src"].eqNullSafe(n["_source"]) & d["h"].eqNullSafe(n["_text_hash"])
    return d.join(n, cond).select("row", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select("row.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return systematic_copies(spark, documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "source")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, text, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CAST([5, 2, 1][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT)] AS DOUBLE) AS w FROM s),
l AS (
  SELECT *, CAST((SUM(source_size) OVER ()) - COALESCE(SUM(3 * source_size) OVER h, 0) AS DOUBLE)
      / ((SUM(w) OVER ()) - COALESCE(SUM(w) OVER h, 0)) AS level
  FROM w WINDOW h AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, LEAST(CAST(3 * source_size AS DOUBLE), w * MAX(level) OVER ()) AS target,
    CAST(('0x' || substr(md5(COALESCE(source, '(null)')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM l),
r AS (
  SELECT d.*, t.source_size, t.target, t.u, CASE WHEN t.source_size = 0 THEN 0 ELSE t.target / CAST(t.source_size AS DOUBLE) END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1 AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor((before + 1) * rate + u) - floor(before * rate + u)) AS BIGINT) AS taken,
  CAST(floor((before + 1) * rate + u) - floor(before * rate + u) AS BIGINT) AS copies, source
FROM r
"""
