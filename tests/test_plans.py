"""Plan checks: pushdown, pruning, partial top-N, no Python in any query."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from clickwin.plans.queries import QUERIES
from clickwin.operators import counts, topn
from clickwin.sources import clicklog as cl

from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_range_is_pushed_to_a_stored_log(spark, tmp_root):
    path = os.path.join(tmp_root, "log")
    cl.clicklog(spark, SF001).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    stored = spark.read.parquet(path)
    plan = _plan(counts.label_counts(stored, "2024010500", "2024010600"))
    assert "PushedFilters: [IsNotNull(TIME), GreaterThanOrEqual(TIME,2024010500), " \
           "LessThan(TIME,2024010600), IsNotNull(CONTENT_LABEL)]" in plan
    assert "ReadSchema: struct<TIME:string,CONTENT_LABEL:string>" in plan


def test_label_count_is_two_phase(spark):
    plan = _plan(counts.label_counts(cl.clicklog(spark, SF001)))
    assert "partial_count" in plan


def test_top_n_uses_partial_window_group_limit(spark):
    df = topn.latest_n_per_group(cl.clicklog(spark, SF001), "CONTENT_TYPE", "TIME", 3, "ID")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_evaluation(spark, name):
    df = QUERIES[name](spark, SF001)        # jobs and streams run; their read-back is looked at
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and \
           "ArrowEvalPython" not in plan


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["ENDTIME", "STARTTIME", "WORD", "FREQUENCY"]
    assert df.count() > 0
    assert df.where(F.col("FREQUENCY") <= 0).count() == 0


def test_day_partitions_are_pruned(spark, tmp_root):
    from clickwin.plans import incremental as inc
    path = os.path.join(tmp_root, "daylog")
    click = cl.clicklog(spark, "/root/testdata/sf0.01")
    cl.write_clicklog(click, path, 8)
    stored = cl.read_clicklog(spark, path)
    window = counts.label_counts(stored, "2024010523", "2024010601")
    plan = _plan(window)
    assert "PartitionFilters: [isnotnull(DAY" in plan and "(DAY#" in plan
    assert sorted(map(tuple, window.collect())) == sorted(
        map(tuple, counts.label_counts(click, "2024010523", "2024010601").collect()))
    files = window._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert "20240105" in plan or files is not None
    ready = inc.window_ready(stored, "2024010600")
    assert ready.first()["READY"] is True
    assert "PartitionFilters: [isnotnull(DAY" in _plan(ready)


def test_full_row_upsert_does_not_shuffle_stored_side(spark):
    # AQE sees the batch is small at run time and broadcasts its keys
    from clickwin.operators import upsert as up
    old = spark.range(100000).selectExpr("CAST(id AS STRING) AS k", "'old' AS v")
    new = spark.createDataFrame([("5", "new"), ("500000", "new")], "k string, v string")
    merged = up.merge_upsert(old, new, ["k"])
    got = {r["k"]: r["v"] for r in merged.collect()}
    assert len(got) == 100001 and got["5"] == "new" and got["500000"] == "new"
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


@pytest.mark.parametrize("start,end", [("2024010500", "2024010600"),
                                       ("202401051234", "202401070001"),
                                       ("20240105123456789", "20240105180000001"),
                                       (None, "20240103"), ("2024012923", None),
                                       ("2024010512345", "202401060")])
def test_window_bounds_reach_events_scan_exactly(spark, start, end):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    sf = "/root/testdata/sf0.01"
    bounded = counts.in_window(cl.clicklog(spark, sf, start, end), start, end)
    full = counts.in_window(cl.clicklog(spark, sf), start, end)
    assert sorted(r["ID"] for r in bounded.select("ID").collect()) == sorted(
        r["ID"] for r in full.select("ID").collect())
    plan = _plan(bounded)
    if start and len(start) in (8, 10, 12, 14, 17):
        assert "GreaterThanOrEqual(ts," in plan
    if end and len(end) in (8, 10, 12, 14, 17):
        assert "LessThan(ts," in plan


def test_stored_log_lists_only_window_days(spark, tmp_root):
    path = os.path.join(tmp_root, "daylog2")
    click = cl.clicklog(spark, SF001)
    cl.write_clicklog(click, path, 4)
    part = cl.read_clicklog(spark, path, "2024010523", "2024010601")
    days = {f.split("DAY=")[1][:8] for f in part.inputFiles()}
    assert days <= {"20240105", "20240106"} and days
    got = counts.label_counts(part, "2024010523", "2024010601")
    want = counts.label_counts(click, "2024010523", "2024010601")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("name", ["upsert_by_key", "upsert_batch"])
def test_upserts_scan_each_input_once(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    assert plan.count("FileScan") == 2      # the stored rows and the batch


def test_cell_job_scans_and_exchanges_cells_once(spark):
    plan = QUERIES["job_latest_n"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning(rowkey") == 1
