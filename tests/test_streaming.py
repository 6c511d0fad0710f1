"""The fitted final-scoring step runs unchanged on a streaming source."""

import tempfile

from pyspark.sql import functions as F

from prepforge.catalog import MODEL_COLS, NUMERIC, LABEL, cleaned
from prepforge.operators import models as M
from prepforge.operators import scale as S
from prepforge.streaming.score import score_frame, score_stream
from tests.conftest import SF_SMALL


def test_stream_scores_equal_batch_scores(spark):
    df = cleaned(spark, SF_SMALL)
    mm = S.fit_minmax(df, NUMERIC)
    model = M.fit_final(mm.transform(df), MODEL_COLS, LABEL)
    src = tempfile.mkdtemp(prefix="prepforge-stream-src-")
    new = df.drop(LABEL)
    new.write.mode("overwrite").parquet(src + "/batch0")
    stream = score_stream(spark, src + "/batch0", new.schema, [mm], model)
    q = stream.writeStream.format("memory").queryName("scores_mem").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {r.id: round(r.score, 9) for r in spark.sql("SELECT * FROM scores_mem").collect()}
    want = {r.id: round(r.score, 9) for r in score_frame(new, [mm], model).collect()}
    assert got == want and len(got) == df.count()
