import datetime as dt

from pyspark.sql import functions as F

from clickwin.operators import counts
from clickwin.plans import backfill as bf
from clickwin.plans import incremental as inc
from clickwin.sources import clicklog as cl

from conftest import SF001, SF01

NOW = dt.datetime(2024, 3, 1)
START = "2024010100"


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_next_window_defaults_and_guards(spark):
    d = inc.next_window(spark, None, 2, default_start="2018092716", now=NOW).first()
    assert (d["STARTTIME"], d["ENDTIME"], d["STATUS"]) == ("2018092716", "2018092718", "run")
    rec = spark.createDataFrame([("2024022923",), ("2024022822",)], "ENDTIME string")
    d = inc.next_window(spark, rec, 1, now=NOW).first()
    # now - start = 1 hour exactly: not "< 1 hour", so it runs
    assert (d["STARTTIME"], d["ENDTIME"], d["STATUS"]) == ("2024022923", "2024030100", "run")
    d = inc.next_window(spark, rec, 1, now=dt.datetime(2024, 2, 29, 23, 30)).first()
    assert d["STATUS"] == "caught_up"
    m = spark.createDataFrame([("202402292350",)], "ENDTIME string")
    d = inc.next_window(spark, m, 10, "MIMUE", inc.MINUTE_KEY, now=NOW, guard="end").first()
    assert (d["ENDTIME"], d["STATUS"]) == ("202403010000", "run")
    d = inc.next_window(spark, m, 20, "MIMUE", inc.MINUTE_KEY, now=NOW, guard="end").first()
    assert d["STATUS"] == "caught_up"


def test_gate_needs_next_hour(spark):
    click = spark.createDataFrame([("20240101000101000",), ("20240101020000000",)], "TIME string")
    assert inc.window_ready(click, "2024010101").first()["READY"] is False
    assert inc.window_ready(click, "2024010101", gate="any_later").first()["READY"] is True
    assert inc.window_ready(click, "2024010102").first()["READY"] is True


def test_launches_then_rerun_are_idempotent(spark, tmp_root):
    click = cl.clicklog(spark, SF01)
    store = inc.label_store(tmp_root)
    r1 = inc.run_window_job(spark, click, store, "label", 24, now=NOW, default_start=START)
    r2 = inc.run_window_job(spark, click, store, "label", 24, now=NOW, default_start=START)
    assert (r1["status"], r1["end"], r2["start"], r2["end"]) == (
        "done", "2024010200", "2024010200", "2024010300")
    before = _sorted(store.results(spark).select("ENDTIME", "STARTTIME", "WORD", "FREQUENCY"))
    want = _sorted(counts.label_pv_window(click, START, "2024010200").union(
        counts.label_pv_window(click, "2024010200", "2024010300")))
    assert before == want
    # a crash after the result write but before the marker: redo the window
    store.write_results(spark, counts.label_pv_window(click, "2024010200", "2024010300"))
    after = _sorted(store.results(spark).select("ENDTIME", "STARTTIME", "WORD", "FREQUENCY"))
    assert after == before


def test_backfill_equals_repeated_launches(spark, tmp_root):
    # sf0.001 has empty hours: the gate stops the launches early
    click = cl.clicklog(spark, SF001)
    store = inc.dim_store(tmp_root)
    runs = 0
    while True:
        r = inc.run_window_job(spark, click, store, "dim", 5, now=NOW, default_start=START)
        if r["status"] != "done":
            break
        runs += 1
        assert runs < 50
    launched = _sorted(store.results(spark).select(
        "ENDTIME", "STARTTIME", *counts.DIMENSIONS, "FREQUENCY"))
    one_pass = _sorted(bf.dim_backfill(click, START, 5, now=NOW))
    assert runs == len({r[0] for r in launched}) > 0
    assert launched == one_pass


def test_backfill_label_windows_and_guard(spark):
    click = cl.clicklog(spark, SF01)
    full = bf.label_backfill(click, START, 24, now=NOW)
    ends = sorted({r["ENDTIME"] for r in full.select("ENDTIME").collect()})
    assert ends[0] == "2024010200" and ends[-1] == "2024013000"  # window 30 lacks a next hour
    day3 = full.where(F.col("ENDTIME") == "2024010400").select("WORD", "FREQUENCY")
    assert _sorted(day3) == _sorted(counts.label_counts(click, "2024010300", "2024010400"))
    # wall clock 00:30 on Jan 3: the window starting Jan 3 00:00 is under an hour old
    early = bf.label_backfill(click, START, 24, now=dt.datetime(2024, 1, 3, 0, 30))
    assert sorted({r[0] for r in early.select("ENDTIME").collect()}) == ["2024010200",
                                                                          "2024010300"]


def test_copy_window(spark, tmp_root):
    click = cl.clicklog(spark, SF001)
    dst = tmp_root + "/copy"
    cols = ["ID", "TIME", "PARAM_TYPE", "URL", "TITLE", "CONTENT_TYPE"]
    inc.copy_window(spark, click, dst, cols, "2024010500", "2024010600")
    inc.copy_window(spark, click, dst, cols, "2024010500", "2024010700")
    got = spark.read.parquet(dst)
    want = click.where((F.col("TIME") >= "2024010500") & (F.col("TIME") < "2024010700"))
    assert got.count() == want.count() > 0
    assert got.select("ID").distinct().count() == got.count()
    # a later copy of another day leaves the copied days untouched
    inc.copy_window(spark, click, dst, cols, "2024010900", "2024010901")
    assert sorted(p.split("DAY=")[1][:8] for p in {f.rsplit("/", 1)[0] for f in
                  spark.read.parquet(dst).inputFiles()}) == ["20240105", "20240106",
                                                             "20240109"]


def test_any_later_gate_skips_empty_hours(spark):
    rows = [("20240101000500000",), ("20240101010500000",), ("20240101030500000",)]
    click = spark.createDataFrame(rows, "TIME string").selectExpr(
        "TIME", "'ios' AS PLATFORM", "'p1' AS PARAM_TYPE", "'view' AS CONTENT_TYPE")
    strict = bf.dim_backfill(click, START, 1, now=NOW)
    assert sorted(r[0] for r in strict.select("ENDTIME").collect()) == ["2024010101"]
    loose = bf.dim_backfill(click, START, 1, now=NOW, gate="any_later")
    # hour 02 is empty but later data exists: windows 00, 01, 02 close
    assert sorted(r[0] for r in loose.select("ENDTIME").collect()) == [
        "2024010101", "2024010102"]


def test_marker_in_results_parity(spark, tmp_root):
    click = cl.clicklog(spark, SF01)
    store = inc.label_store(tmp_root, marker_in_results=True)
    r1 = inc.run_window_job(spark, click, store, "label", 1, now=NOW, default_start=START)
    r2 = inc.run_window_job(spark, click, store, "label", 1, now=NOW, default_start=START)
    assert (r1["end"], r2["start"], r2["end"]) == ("2024010101", "2024010101", "2024010102")
    res = store.results(spark)
    markers = res.where(F.col("WORD").isNull()).collect()
    assert sorted(r["ENDTIME"] for r in markers) == ["2024010101", "2024010102"]
    assert all(r["FREQUENCY"] is None for r in markers)


def test_catch_up_marks_every_ready_window_and_resumes(spark, tmp_root):
    click = cl.clicklog(spark, SF001)
    store = inc.dim_store(tmp_root)
    r1 = inc.run_catch_up(spark, click, store, "dim", 5, now=NOW, default_start=START)
    r2 = inc.run_catch_up(spark, click, store, "dim", 5, now=NOW, default_start=START)
    assert r1["status"] == "done" and r1["windows"] > 0
    assert r2["status"] == "not_ready" and r2["start"] == r1["end"]
    got = _sorted(store.results(spark).select("ENDTIME", "STARTTIME", *counts.DIMENSIONS,
                                              "FREQUENCY"))
    assert got == _sorted(bf.dim_backfill(click, START, 5, now=NOW))
    marks = store.markers(spark)
    assert marks.count() == r1["windows"]
    # the one-window job continues exactly where the catch-up stopped
    nxt = inc.next_window(spark, marks, 5, now=NOW).first()
    assert nxt["STARTTIME"] == r1["end"]


def test_catch_up_with_nothing_ready(spark, tmp_root):
    click = cl.clicklog(spark, SF001)
    store = inc.label_store(tmp_root)
    r = inc.run_catch_up(spark, click, store, "label", 1, now=NOW, default_start="2030010100")
    assert r["status"] in ("not_ready", "caught_up") and r["windows"] == 0


def test_results_of_an_empty_store_is_a_clear_error(spark, tmp_root):
    import pytest
    store = inc.label_store(tmp_root)
    assert store.markers(spark) is None
    with pytest.raises(FileNotFoundError):
        store.results(spark)


def test_two_jobs_share_a_root_and_markers_are_appended(spark, tmp_root):
    a, b = inc.label_store(tmp_root), inc.dim_store(tmp_root)
    for end in ("2024010101", "2024010102", "2024010102"):
        a.mark(spark, "s", end)
    b.mark(spark, "s", "2024010107")
    assert sorted(r.ENDTIME for r in a.markers(spark).collect()) == ["2024010101", "2024010102"]
    assert [r.ENDTIME for r in b.markers(spark).collect()] == ["2024010107"]


def test_marker_in_results_without_label_rows(spark, tmp_root):
    store = inc.label_store(tmp_root, marker_in_results=True)
    store.mark(spark, "2024010100", "2024010101")
    assert [tuple(r) for r in store.results(spark).collect()] == [("2024010101", "2024010100", None, None)]
    nxt = inc.next_window(spark, store.markers(spark), 1).first()
    assert nxt["STARTTIME"] == "2024010101"


def test_appended_file_is_seen_by_the_next_read(spark, tmp_root):
    from clickwin.sources import clicklog as cl
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("d", F.lit(1))
    rows.limit(10).write.partitionBy("d").parquet(f"{tmp_root}/events.parquet")
    assert cl.clicklog(spark, tmp_root).count() == 10
    rows.limit(5).write.mode("append").partitionBy("d").parquet(f"{tmp_root}/events.parquet")
    assert cl.clicklog(spark, tmp_root).count() == 15


def test_malformed_times_count_neither_in_launches_nor_in_the_catch_up(spark, tmp_root):
    click = spark.createDataFrame(
        [("20240101013000000", "a"), ("2024010199zz", "a"), ("20240101023000000", "b"),
         ("2024010107oops", "c"), ("20240102003000000", "d"), ("2024 bad", "e")],
        "TIME string, CONTENT_LABEL string")
    out = []
    for launch in (inc.run_window_job, inc.run_catch_up):
        store = inc.label_store(f"{tmp_root}/{launch.__name__}")
        status = launch(spark, click, store, "label", 24, now=dt.datetime(2024, 3, 1),
                        default_start="2024010100")
        assert status["status"] == "done"
        out.append(sorted((r.WORD, r.FREQUENCY) for r in store.results(spark).collect()))
    assert out[0] == out[1] == [("a", 1), ("b", 1), ("c", 1)]
