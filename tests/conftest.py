import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from prepforge.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app="prepforge-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="prepforge-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from prepforge.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
