import os

from pyspark.sql import functions as F

from clickwin.operators import cells as cx
from clickwin.sources import clicklog as cl

CELLS = "rowkey string, family string, qualifier string, value string"


def test_cells_to_map_sorted_and_drop_last(spark):
    cells = spark.createDataFrame([("r1", "info", "b", "2"), ("r1", "info", "a", "1"),
                                   ("r1", "info", "c", "3"), ("r2", "info", "a", "x")], CELLS)
    got = {r["rowkey"]: r["cells"] for r in cx.cells_to_map(cells).collect()}
    assert list(got["r1"].items()) == [("a", "1"), ("b", "2"), ("c", "3")]
    dropped = {r["rowkey"]: r["cells"] for r in cx.cells_to_map(cells, drop_last=True).collect()}
    assert list(dropped["r1"].items()) == [("a", "1"), ("b", "2")]
    assert dropped["r2"] == {}


def test_cell_count_filter_and_wide_padding(spark):
    cells = spark.createDataFrame([("r1", "info", q, q.upper()) for q in "abc"]
                                  + [("r2", "info", "a", "A")], CELLS)
    m = cx.filter_cell_count(cx.cells_to_map(cells), 3)
    wide = cx.cells_to_wide(m, 3, 5).collect()
    assert [tuple(r) for r in wide] == [("A", "B", "C", "C", "C")]


def test_rows_to_cells_null_text(spark):
    df = spark.createDataFrame([("k1", "x", None)], "id string, a string, b string")
    got = sorted(tuple(r) for r in cx.rows_to_cells(df, "id", ["a", "b"], null_text="null")
                 .collect())
    assert got == [("k1", "info", "a", "x"), ("k1", "info", "b", "null")]
    absent = cx.rows_to_cells(df, "id", ["a", "b"]).collect()
    assert len(absent) == 1


def test_key_range_scan_on_sorted_files(spark, tmp_root):
    cells = cl.cells_from_clicklog(cl.clicklog(spark, "/root/testdata/sf0.001"))
    path = os.path.join(tmp_root, "cells")
    cl.write_sorted_cells(cells, path, 4)
    stored = spark.read.parquet(path)
    got = cx.scan_key_range(stored, "0010", "0020", "info")
    want = cells.where((F.col("rowkey") >= "0010") & (F.col("rowkey") < "0020"))
    assert got.count() == want.count() > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(rowkey,0010)" in plan


def test_long_device_ids_stay_whole_and_rows_unique(spark):
    import datetime as dt
    at = dt.datetime(2024, 1, 5, 1, 2, 3, 4000)
    events = spark.createDataFrame(
        [(i, at, u, "click") for i, u in enumerate((7, 1000, 9999, 10000, 10007, 10007))],
        "event_id long, ts timestamp_ntz, user_id long, event_type string")
    click = cl.clicklog_from_events(events)
    assert sorted(r.UDID for r in click.collect()) == ["0007", "1000", "10000", "10007", "10007", "9999"]
    cells = cl.cells_from_clicklog(click)
    assert cells.select("rowkey").distinct().count() == 6
    full = cx.cells_to_map(cx.scan_key_range(cells, "0000", None)).collect()
    assert len(full) == 6 and any("9999_" in r.rowkey for r in full)


def test_families_and_repeated_cells(spark):
    cells = spark.createDataFrame([("r", "a", "q", "1"), ("r", "b", "q", "2"), ("r", "a", "q", "1"),
                                   ("r", "a", "q", "0"), ("r", "a", "p", None)], CELLS)
    got = sorted((r["cells"] for r in cx.cells_to_map(cells).collect()), key=len)
    assert got == [{"q": "2"}, {"p": None, "q": "1"}]
    two = cx.cells_of_rows_with_n(cells, 2)
    assert {r["family"] for r in two.collect()} == {"a"}
    assert [r["cells"] for r in cx.cells_to_map(two).collect()] == [{"p": None, "q": "1"}]
