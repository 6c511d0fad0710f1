"""Score arriving rows with a fitted model (the final-scoring step on a stream).

The reference has no streaming.  Its last step scores a new table with a
fixed, fitted model; every fitted transform here is a column projection, so
the same step applies unchanged to a Structured Streaming source: no state,
no watermark, one narrow stage per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from prepforge.operators.models import positive_prob


def score_frame(df: DataFrame, transforms, model, keep=("id",)) -> DataFrame:
    """Apply fitted column transforms in order, then the fitted model."""
    for t in transforms:
        df = t.transform(df)
    return model.transform(df).select(*keep, positive_prob().alias("score"), "prediction")


def score_stream(spark: SparkSession, source_dir: str, schema: T.StructType, transforms, model,
                 keep=("id",), fmt: str = "parquet", max_files_per_trigger: int = 1) -> DataFrame:
    """A streaming DataFrame of scores for files arriving under ``source_dir``."""
    stream = (spark.readStream.schema(schema).format(fmt)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir))
    return score_frame(stream, transforms, model, keep)
