"""Operator 5: near-duplicate vectors by random-hyperplane hashing and exact cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepforge.llm.common import connected_components, materialize, prepare

#: Least cosine of a link (fixed by the task).
COSINE = 0.98
#: Sign bits of a key and number of tables. A pair at cosine 0.98 agrees on a bit with
#: probability 0.936, on a key with 0.27, and in some table with 0.9994.
BITS, TABLES = 20, 24
#: Rows of a bucket that one task compares with one another; larger buckets are cut into tiles.
TILE = 1024


def planes(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))


def group_links(ids, tile, vecs, norms, mult, keys, table, cosine):
    """Links inside one bucket or pair of tiles: per row the linked rows (with their copies)
    first met in this table, and a star per group of linked rows."""
    n = len(ids)
    count, root = np.zeros(n, np.int64), np.arange(n)
    left, right = [], []
    for s in range(0, n, 512):
        c = (vecs[s:s + 512] @ vecs.T) / (norms[s:s + 512, None] * norms[None, :])
        i, j = np.nonzero(c >= cosine)
        i = i + s
        ok = (i < j) & ((tile[i] != tile[j]) if tile.min() != tile.max() else True)
        i, j = i[ok], j[ok]
        new = (keys[i, :table] != keys[j, :table]).all(axis=1)
        np.add.at(count, i[new], mult[j[new]])
        np.add.at(count, j[new], mult[i[new]])
        left.append(i)
        right.append(j)
    i, j = np.concatenate(left), np.concatenate(right)
    while len(i):
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (before == root).all():
            break
    linked = np.unique(np.concatenate([i, j]))
    return linked, count[linked], ids[root[linked]]


def cosine_groups(spark: SparkSession, vectors: DataFrame, cosine: float = COSINE, bits: int = BITS,
                  tables: int = TABLES, seed: int = 11) -> DataFrame:
    """(vec_id, label, n_links, component_id, kept) of every row of ``vectors``.

    Rows with the same label and components are one class with a number of copies. Each class
    gets ``tables`` keys of ``bits`` signs; classes of one label, length and key are compared
    by cosine in double precision (tiles of a large bucket in separate tasks) and linked at
    ``cosine`` or more. A pair is counted in the first table in which it meets, so pairs are
    never written out: tasks return counts and one star per group. ``n_links`` counts the other
    rows linked directly, copies included.

    A null label, or a vector that is null, empty, zero or holds null or non-finite components,
    links with nothing. Vectors of different lengths never link. A null vec_id links with
    nothing and has a null component and kept false. Repeated rows are copies of one another and
    are all returned. Empty tables give no rows; other columns are not looked at.
    """
    prepare(spark)
    e = F.col("e")
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label"), F.col("embedding").cast("array<double>").alias("e"))
    good = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull()
            & F.coalesce(F.forall(e, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists(e, lambda x: x != 0), F.lit(False)))
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    rows = rows.withColumn("k1", F.when(F.col("good"), F.xxhash64("e"))) \
        .withColumn("k2", F.when(F.col("good"), F.xxhash64(F.lit(1), F.reverse("e"))))
    rows = materialize(spark, rows.select("vec_id", "label", "good", "k1", "k2", F.when(F.col("good"), e).alias("e")), "vec")
    klass = rows.where("good").groupBy("label", "k1", "k2").agg(
        F.min("vec_id").alias("cid"), F.count("*").alias("mult"), F.any_value("e").alias("e"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for b in batches:
            out = []
            for v in b.column(b.schema.get_field_index("e")).to_pylist():
                x = np.array(v)
                if len(x) not in made:
                    made[len(x)] = planes(len(x), bits, tables, seed)
                sign = (x / np.abs(x).max() @ made[len(x)] > 0).reshape(tables, bits)
                out.append((sign @ (1 << np.arange(bits))).astype(np.int32).tolist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.int32()))],
                                             names=[*b.schema.names, "keys"])

    klass = klass.select("cid", "label", "k1", "k2", "mult", "e")
    klass = materialize(spark, klass.mapInArrow(
        hashed, "cid long, label {}, k1 long, k2 long, mult long, e array<double>, keys array<int>".format(
            rows.schema["label"].dataType.simpleString())), "class")
    bucket = ["label", "dim", "tab", "key"]
    keyed = klass.select("cid", "label", F.size("e").alias("dim"), F.posexplode("keys").alias("tab", "key"))
    crowded = keyed.groupBy(*bucket).count().where("count > 1").withColumn(
        "tiles", F.ceil(F.col("count") / F.lit(TILE)).cast("int"))
    member = keyed.join(crowded, bucket).withColumn(
        "tile", F.pmod(F.xxhash64("cid"), F.col("tiles")).cast("int"))
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "cid", *bucket, "tile",
        F.least("tile", "other").alias("ti"), F.greatest("tile", "other").alias("tj"))
    group = ["label", "dim", "tab", "key", "ti", "tj"]
    full = member.select("cid", "tile", *group).join(klass.select("cid", "mult", "e", "keys"), "cid")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(part: pa.Table):
            ids = part["cid"].to_numpy()
            if len(ids) < 2:
                return None
            v = part["e"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            v = v / np.abs(v).max(axis=1, keepdims=True)
            keys = part["keys"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            order = np.argsort(ids)
            who, n, root = group_links(ids[order], part["tile"].to_numpy()[order], v[order],
                                       np.sqrt((v * v).sum(1))[order], part["mult"].to_numpy()[order],
                                       keys[order], part["tab"][0].as_py(), cosine)
            return pa.RecordBatch.from_arrays([pa.array(ids[order][who]), pa.array(n), pa.array(root)],
                                              names=["cid", "n", "root"]) if len(who) else None

        rest = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            if not t.num_rows:
                continue
            cols = [t[c].combine_chunks().dictionary_encode().indices.to_numpy() for c in group]
            change = np.zeros(t.num_rows - 1, bool)
            for c in cols:
                change |= c[1:] != c[:-1]
            cut = [0, *(np.flatnonzero(change) + 1).tolist()]
            for s, x in zip(cut, cut[1:]):
                if (r := solve(t.slice(s, x - s))) is not None:
                    yield r
            rest = t.slice(cut[-1])
        if rest is not None and (r := solve(rest)) is not None:
            yield r

    met = materialize(spark, full.repartition(*group).sortWithinPartitions(*group)
                      .mapInArrow(compare, "cid long, n long, root long"), "met")
    n = met.groupBy("cid").agg(F.sum("n").alias("n"))
    parts = connected_components(spark, met.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    named = klass.select("label", "k1", "k2", "cid", "mult").join(n, "cid", "left").join(
        parts, F.col("cid") == parts["node"], "left").select(
        "label", "k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
        F.coalesce("component", "cid").alias("component_id"))
    return rows.select("vec_id", "label", "k1", "k2").join(named, ["label", "k1", "k2"], "left").select(
        "vec_id", "label", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cosine_groups(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet")).select(
        "vec_id", "n_links", "component_id", "kept")


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
r AS (
  SELECT vec_id AS n, vec_id AS c FROM embeddings
  UNION
  SELECT p.b, r.c FROM r JOIN p ON p.a = r.n),
c AS (SELECT n, MIN(c) AS c FROM r GROUP BY n)
SELECT e.vec_id, (SELECT COUNT(*) FROM p WHERE p.a = e.vec_id) AS n_links, c.c AS component_id,
  e.vec_id = c.c AS kept
FROM embeddings e JOIN c ON c.n = e.vec_id
"""
