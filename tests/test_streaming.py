import datetime as dt

from pyspark.sql import functions as F

from clickwin.plans import backfill as bf
from clickwin.session import scratch_path
from clickwin.sources import clicklog as cl
from clickwin.streaming import counts as sc

from conftest import SF01

EVENTS = f"{SF01}/events.parquet"


def test_stream_equals_catch_up_on_closed_windows(spark):
    events = sc.event_stream(spark, EVENTS)
    sink = scratch_path(spark, "test-stream")
    q = sc.start_to_parquet(sc.stream_dim_counts(events, delay="0 seconds"), sink, sink + "-ckpt")
    q.awaitTermination()
    streamed = spark.read.parquet(sink)
    batch = bf.dim_backfill(cl.clicklog(spark, SF01), "2024010100", 1,
                            now=dt.datetime(2024, 3, 1))
    s = sorted((tuple(r) for r in streamed.collect()), key=repr)
    b = sorted((tuple(r) for r in batch.select(*streamed.columns).collect()), key=repr)
    assert s == b and len(s) > 0
    # a restart of the same query finds nothing new (exactly-once sink)
    q2 = sc.start_to_parquet(sc.stream_dim_counts(events, delay="0 seconds"), sink, sink + "-ckpt")
    q2.awaitTermination()
    assert spark.read.parquet(sink).count() == len(s)


def test_stream_label_delay_holds_back_one_more_window(spark):
    events = sc.event_stream(spark, EVENTS)
    out = {}
    for delay in ("0 seconds", "1 hour"):
        sink = scratch_path(spark, "test-stream-delay")
        sc.start_to_parquet(sc.stream_label_counts(events, delay=delay), sink,
                            sink + "-ckpt").awaitTermination()
        out[delay] = spark.read.parquet(sink).select(F.max("ENDTIME")).first()[0]
    assert out["0 seconds"] == "2024013023" and out["1 hour"] == "2024013022"


def test_stream_into_keyed_store_matches_batch_launch(spark, tmp_root):
    from clickwin.plans import incremental as inc
    events = sc.event_stream(spark, EVENTS, max_files_per_trigger=1)
    store = inc.label_store(tmp_root)
    ckpt = scratch_path(spark, "test-stream-store")
    sc.start_to_store(sc.stream_label_counts(events, delay="0 seconds"), store, ckpt).awaitTermination()
    got = store.results(spark)
    marks = store.markers(spark)
    assert marks.count() == got.select("ENDTIME").distinct().count() > 700
    # the next launch of the batch job continues after the last streamed window
    nxt = inc.next_window(spark, marks, 1, now=dt.datetime(2024, 3, 1)).first()
    assert nxt["STARTTIME"] == "2024013023"
    batch = bf.label_backfill(cl.clicklog(spark, SF01), "2024010100", 1,
                              now=dt.datetime(2024, 3, 1))
    cols = ["ENDTIME", "STARTTIME", "WORD", "FREQUENCY"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(
        map(tuple, batch.select(*cols).collect()))


def test_rocksdb_state_store_gives_same_windows(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    sc.use_rocksdb_state(spark)
    try:
        assert spark.conf.get(key).endswith("RocksDBStateStoreProvider")
        events = sc.event_stream(spark, EVENTS)
        sink = scratch_path(spark, "test-rocks")
        sc.start_to_parquet(sc.stream_dim_counts(events, delay="0 seconds"), sink, sink + "-ckpt").awaitTermination()
        assert spark.read.parquet(sink).count() == 9110
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def test_folder_table_equals_the_single_file(spark, tmp_root):
    folder = f"{tmp_root}/events"
    spark.read.parquet(EVENTS).orderBy("ts").repartitionByRange(3, "ts").write.parquet(folder)
    out = []
    for table in (EVENTS, folder):
        sink = scratch_path(spark, "test-folder")
        events = sc.event_stream(spark, table)
        sc.start_to_parquet(sc.stream_label_counts(events, delay="0 seconds"), sink,
                            sink + "-ckpt").awaitTermination()
        out.append(sorted(map(tuple, spark.read.parquet(sink).collect())))
    assert out[0] == out[1] and out[0]


def test_late_rows_are_counted_and_a_lateness_keeps_them(spark, tmp_root):
    """Three one-file micro-batches, newest rows first."""
    import os
    import time
    events = spark.read.parquet(EVENTS)
    folder = f"{tmp_root}/late"
    for part, bounds in enumerate((("2024-01-21", "2024-02-01"), ("2024-01-11", "2024-01-21"),
                                   ("2024-01-01", "2024-01-11"))):
        rows = events.where(F.col("ts").between(*[F.lit(b).cast("timestamp_ntz") for b in bounds]))
        rows.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)         # file streams take older files first
    dropped, kept = {}, {}
    for delay in ("0 seconds", "60 days"):
        sink = scratch_path(spark, "test-late")
        q = sc.start_to_parquet(sc.stream_dim_counts(
            sc.event_stream(spark, folder, max_files_per_trigger=1), delay=delay), sink, sink + "-ckpt")
        q.awaitTermination()
        dropped[delay] = sc.dropped_rows(q)
        kept[delay] = sum(int(op["numRowsUpdated"]) for p in q.recentProgress
                          for op in p["stateOperators"])
    assert os.path.isdir(folder) and dropped["0 seconds"] > 0
    assert dropped["60 days"] == 0 and kept["60 days"] > kept["0 seconds"]
