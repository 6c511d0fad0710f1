"""The matrix queries look at every numeric column."""
import numpy as np

from prepforge import catalog as C


def test_a_row_that_stands_out_in_any_column_is_flagged(spark, monkeypatch):
    r = np.random.default_rng(2)
    x = r.normal(0, 1, (400, len(C.NUMERIC)))
    for j in range(len(C.NUMERIC)):
        x[j, j] = 40.0
    rest = [C.LABEL, *C.C360_FLAGS]
    rows = [(i, *map(float, v), *[0] * len(rest)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, ", ".join(["id long", *[f"{c} double" for c in C.NUMERIC], *[f"{c} int" for c in rest]]))
    monkeypatch.setattr(C, "cleaned", lambda spark, sf: df)
    top = [r["id"] for r in C.QUERIES["mahalanobis_scores"](spark, "").orderBy("md", ascending=False).limit(len(C.NUMERIC)).collect()]
    assert sorted(top) == list(range(len(C.NUMERIC)))
