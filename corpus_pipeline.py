"""Training-corpus pipeline: each stage reads what the one before kept.

1. quality classifier: documents that the scorer rejects go;
2. SimHash near-dedup: of each group of near copies the row of the least doc_id stays (nulls last);
3. secret scans: spans found are replaced in the texts, n_chars is counted anew;
4. mixing: each source's documents are repeated or left out to meet its target;
5. packing: every document that came through is cut into sequences; returns the pieces.

Stages 1 to 4 return the columns of ``documents``. Nulls, empty texts, ties, repeated rows and
empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from prepforge.llm import mixing, packing, quality, secrets, simhash
from prepforge.session import ensure_checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    weights, _ = quality.fit(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(spark, docs, weights)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each_group(spark, docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(spark, docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", simhash_stage),
    ("secret scans", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can't express the trained models; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the last stage makes of ``documents``."""
    folder = f"{ensure_checkpoint_dir(spark)}/prepforge-llm/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
