"""Plan guards: no cartesian products, filters reach the scan, prefix sums
stay off a single partition."""

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_in_neighbour_plans(spark, monkeypatch):
    """Every table that the neighbour searches write, and the joins that read them."""
    from prepforge import catalog as CAT
    from prepforge.operators import neighbors as NB
    from prepforge.plans import knn
    plans = []

    def spy(df, tag, real=knn.written):
        plans.append(_plan(df))
        return real(df, tag)
    monkeypatch.setattr(knn, "written", spy)
    monkeypatch.setattr(NB, "written", spy)
    df = CAT.scaled(spark, SF_SMALL)
    plans += [_plan(NB.dbscan_noise(df, CAT.NUMERIC, 0.8, 5)), _plan(NB.local_outlier_factor(df, CAT.NUMERIC, 5))]
    assert len(plans) > 15
    for p in plans:
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_filter_pushed_to_scan(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_discount >= 0.08").select("l_orderkey")
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(l_discount), GreaterThanOrEqual(l_discount,0.08)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_discount:double>" in p


def test_c360_reads_only_needed_columns(spark):
    from prepforge.sources.tables import c360
    p = _plan(c360(spark, SF_SMALL))
    assert "l_shipdate" not in p and "l_tax" not in p and "c_name" not in p


def test_roc_window_is_partitioned(spark):
    from prepforge.catalog import scored
    from prepforge.operators import evaluate as EV
    p = _plan(EV.roc_points(scored(spark, SF_SMALL), "response", "score"))
    # the windows are partitioned by the range partition, or run over the table of partition totals
    assert p.count("SinglePartition") == 1 and "hashpartitioning(__pid" in p


def test_orders_are_dealt_over_tasks_that_follow_the_rows(spark, tmp_path, monkeypatch):
    """c360 adds up no orders in the tasks that scan line items: it deals them by key, over more tasks for more rows."""
    from prepforge.sources import tables
    rows = {"customer": "id c_custkey, id % 5 c_nationkey, double(id) c_acctbal, 'A' c_mktsegment",
            "part": "id p_partkey, 'LARGE X' p_type",
            "orders": "id o_orderkey, id % 7 o_custkey, date'1996-01-01' + int(id) o_orderdate, '1-URGENT' o_orderpriority",
            "lineitem": "id % 40 l_orderkey, id % 40 l_partkey, double(id) l_extendedprice, 0.1D l_discount, 'R' l_returnflag",
            "events": "id % 7 user_id, 'view' event_type"}
    for name, cols in rows.items():
        spark.range(120 if name == "lineitem" else 40).selectExpr(*cols.split(", ")).write.parquet(f"{tmp_path}/{name}.parquet")
    few = sorted(map(str, tables.c360(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(tables, "TASK_ROWS", 2)
    many = tables.c360(spark, str(tmp_path))
    p = _plan(many)
    for key in ("l_orderkey", "o_orderkey"):
        assert [line for line in p.splitlines() if f"hashpartitioning({key}" in line and ", 60)" in line]
    scan = p[p.index("hashpartitioning(l_orderkey"):]
    assert "keys=[l_orderkey" not in scan and "keys=[l_orderkey" in p
    assert sorted(map(str, many.collect())) == few


def test_no_join_of_the_customer_view_sorts_line_items_by_part(spark, monkeypatch):
    """The part lookup is hashed, and customers' orders go to a number of tasks that follows the rows, not the session's."""
    from prepforge.sources import tables
    monkeypatch.setattr(tables, "TASK_ROWS", 100)
    n = -(-spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count() // 100)
    p = _plan(tables.c360(spark, SF_SMALL))
    assert "ShuffledHashJoin [l_partkey" in p and "SortMergeJoin [l_partkey" not in p and "BroadcastHashJoin [l_partkey" not in p
    for key in ("o_custkey", "c_custkey", "user_id"):
        deal = [line for line in p.splitlines() if f"hashpartitioning({key}" in line]
        assert any(f", {n})" in line for line in deal), key


def test_votes_scan_a_written_table(spark, monkeypatch):
    """The detectors and the smoothing don't read the view's checkpoint again and again."""
    from pyspark.sql import functions as F

    from prepforge import catalog as K
    df = spark.range(200).select("id", *[((F.col("id") * (i + 3)) % 17).cast("double").alias(c) for i, c in enumerate(K.NUMERIC)]).checkpoint()
    monkeypatch.setattr(K, "_num", lambda *a: df)
    out = K.QUERIES["outlier_smooth"](spark, "unused")
    assert "ExistingRDD" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() <= 200
