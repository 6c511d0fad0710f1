"""Seeded splits and folds with exact per-label counts.

Rows are ordered by ``xxhash64(id, seed)`` (stable under any partitioning,
so the same seed gives the same split on 1 or 1000 executors); the rank in
that order is computed by :func:`prepforge.plans.prefix.hash_rank`, whose
ranges keep a label holding most rows spread over many tasks.  Rows with a null
label are a class of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepforge.plans.prefix import hash_rank, null_safe_join


def _ranked(df: DataFrame, id_col: str, seed: int, group_cols=()) -> DataFrame:
    h = df.withColumn("__h", F.xxhash64(F.col(id_col), F.lit(seed)))
    return hash_rank(h, "__h", group_cols, tie_col=id_col, out="__rank")


def split_stratified(df: DataFrame, label_col: str, test_frac: float = 0.2, seed: int = 0,
                     id_col: str = "id") -> DataFrame:
    """Adds ``split`` in {train, test}; each label gets round(n_label * frac) test rows."""
    r = _ranked(df, id_col, seed, [label_col])
    n = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("__n"))  # one row per label
    r = null_safe_join(r, n, [label_col], "left")
    k = F.floor(F.col("__n") * F.lit(test_frac) + F.lit(0.5))
    return r.withColumn("split", F.when(F.col("__rank") < k, "test").otherwise("train")) \
        .drop("__h", "__rank", "__n")


def split_random(df: DataFrame, test_frac: float = 0.2, seed: int = 0, id_col: str = "id") -> DataFrame:
    n = df.count()
    k = int(n * test_frac + 0.5)
    r = _ranked(df, id_col, seed)
    return r.withColumn("split", F.when(F.col("__rank") < k, "test").otherwise("train")) \
        .drop("__h", "__rank")


def kfold(df: DataFrame, k: int = 5, seed: int = 0, id_col: str = "id",
          label_col: str | None = None) -> DataFrame:
    """Adds ``fold`` in 0..k-1: rank mod k in hash order (within label when
    ``label_col`` is given), so fold sizes per label differ by at most one."""
    r = _ranked(df, id_col, seed, [label_col] if label_col else [])
    return r.withColumn("fold", (F.col("__rank") % k).cast("int")).drop("__h", "__rank")


def kfold_stratified(df: DataFrame, label_col: str, k: int = 5, seed: int = 0,
                     id_col: str = "id") -> DataFrame:
    return kfold(df, k, seed, id_col, label_col)
