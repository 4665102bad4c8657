"""Tumbling-window label and dimension counts as streaming queries.

The batch jobs close a window once later data has arrived; a watermark
expresses the same rule in Structured Streaming: with delay ``d`` a window
``[s, e)`` is final once an event with time ``>= e + d`` has been seen.
Append mode then emits each window exactly once; state holds only open
windows.  With ``d = 0`` and no empty hours the emitted windows equal the
catch-up job's; each hour of delay holds one more window back, and records
older than the watermark are dropped (as the batch jobs ignore data that
arrives after their window was closed).

Sources are file streams (Parquet files landing in a folder); the sink is a
Parquet folder with a checkpoint location, so a restarted query resumes
exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from clickwin.functions.labels import split_labels
from clickwin.functions.timekeys import HOUR_KEY
from clickwin.operators.counts import DIMENSIONS
from clickwin.sources.clicklog import clicklog_from_events


def event_stream(spark: SparkSession, table: str, max_files_per_trigger: int | None = None
                 ) -> DataFrame:
    """Stream of ``events`` rows from a table: one Parquet file, or a folder
    that part files arrive in.

    The schema is read once from the files already present (file streams
    need a fixed schema).
    """
    r = spark.readStream.format("parquet").schema(spark.read.parquet(table).schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(path).isFile():     # file streams watch folders
        return r.option("pathGlobFilter", path.getName()).load(str(path.getParent()))
    return r.load(table)


def dropped_rows(query: StreamingQuery) -> int:
    """Aggregated rows that came too late for their window, over the query's
    recorded progress.  More than 0 means the lateness was set too low."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress
               for op in p["stateOperators"])


def stream_label_counts(events: DataFrame, window: str = "1 hour", *, delay: str) -> DataFrame:
    """Streaming ``(ENDTIME, STARTTIME, WORD, FREQUENCY)`` per tumbling window.

    ``delay`` is the lateness to wait for; rows later than that are dropped
    (see ``dropped_rows``), so it has no default.
    """
    click = _click_with_ts(events)
    agg = (click.withWatermark("EVENT_TS", delay)
           .where(F.col("CONTENT_LABEL").isNotNull())
           .select("EVENT_TS", F.explode(split_labels("CONTENT_LABEL")).alias("WORD"))
           .groupBy(F.window("EVENT_TS", window).alias("w"), "WORD")
           .agg(F.count(F.lit(1)).alias("FREQUENCY")))
    return _tag(agg, ["WORD"])


def stream_dim_counts(events: DataFrame, window: str = "1 hour",
                      dims: Sequence[str] = DIMENSIONS, *, delay: str) -> DataFrame:
    """Streaming ``(ENDTIME, STARTTIME, *dims, FREQUENCY)`` per tumbling window;
    ``delay`` as in ``stream_label_counts``."""
    click = _click_with_ts(events)
    agg = (click.withWatermark("EVENT_TS", delay)
           .groupBy(F.window("EVENT_TS", window).alias("w"), *dims)
           .agg(F.count(F.lit(1)).alias("FREQUENCY")))
    return _tag(agg, list(dims))


def _click_with_ts(events: DataFrame) -> DataFrame:
    # watermarks need TIMESTAMP, the stored column is TIMESTAMP_NTZ
    ev = events.withColumn("EVENT_TS", F.col("ts").cast("timestamp"))
    return clicklog_from_events(ev, keep=("EVENT_TS",))


def _tag(agg: DataFrame, keys: list[str]) -> DataFrame:
    return agg.select(F.date_format(F.col("w.end"), HOUR_KEY).alias("ENDTIME"),
                      F.date_format(F.col("w.start"), HOUR_KEY).alias("STARTTIME"),
                      *keys, "FREQUENCY")


def start_to_parquet(df: DataFrame, sink: str, checkpoint: str,
                     available_now: bool = True, processing_time: str | None = None
                     ) -> StreamingQuery:
    """Append the stream to a Parquet folder (exactly once via the checkpoint)."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", sink))
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=processing_time or "1 minute")
    return w.start()


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep window state in RocksDB (off-heap, spills to local disk and
    snapshots to the checkpoint) instead of the JVM heap.  Must be set before
    a query first starts; an explicit user setting is left alone."""
    key = "spark.sql.streaming.stateStore.providerClass"
    current = spark.conf.get(key, None)
    if current is None or current.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(key, ROCKSDB)


def start_to_store(df: DataFrame, store, checkpoint: str, available_now: bool = True,
                   processing_time: str | None = None) -> StreamingQuery:
    """Write closed windows into the batch jobs' keyed result store.

    Each micro-batch holds windows the watermark has closed; they are
    upserted by key (so a micro-batch replayed after a failure rewrites the
    same rows) and published with a marker per window -- the same protocol as
    ``plans.incremental.run_window_job``.
    """
    spark = df.sparkSession

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        # read three times (empty check, keyed write, markers): keep it rather
        # than recompute the stateful micro-batch; spills to disk if large
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():  # no window closed in this micro-batch
                return
            windows = batch.select("ENDTIME", "STARTTIME").distinct()
            store.publish(spark, batch, windows)
        finally:
            batch.unpersist()

    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint) \
        .foreachBatch(write_batch)
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=processing_time or "1 minute")
    return w.start()
