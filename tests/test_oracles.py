"""Every query with an oracle matches DuckDB on the smallest driver tables
(row count, column names, order-insensitive values at 6 digits)."""

import math

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

KEYS = sorted(E.oracle_sql())


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return float(v)
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("key", KEYS)
def test_matches_duckdb(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(df.columns, s_rows) == _rows(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "income_per_person" in df.columns
