"""Incremental window jobs: one window per launch, driven by recorded results.

A launch (1) reads the greatest recorded window end -- the next window's
start -- from the marker table, (2) derives ``[start, start + step)`` and
applies the guard, (3) checks the completeness gate (data exists in the hour
after the window), (4) counts the window and (5) publishes its rows and its
marker in one step.  A crash before that leaves the store as it was, so the
next launch computes the window again.

Only one-row descriptors (window bounds, ready flag) reach the driver.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clickwin.functions.timekeys import (HOUR_KEY, MINUTE_KEY, add_to_key, key_to_ms,
                                         now_millis, shift_key)
from clickwin.operators import counts
from clickwin.operators import upsert as up
from clickwin.sources.snapshots import Store, Table

MARKER_SCHEMA = StructType([StructField("TABLE_NAME", StringType(), False),
                            StructField("ENDTIME", StringType(), True),
                            StructField("STARTTIME", StringType(), True)])

MS_PER_HOUR = 3_600_000

# Fixed value: default first window start (hour key) of the reference's jobs.
DEFAULT_START = "2018092716"


def rows_between(source, start: str | None, end: str | None) -> DataFrame:
    """Rows of ``[start, end)`` from a DataFrame or from a source factory.

    A factory ``(start, end) -> DataFrame`` lets the source turn the window
    into scan-level predicates (partition folders, pushed filters on stored
    event times); the window filter on ``TIME`` is applied on top either way.
    """
    df = source(start, end) if callable(source) else source
    return counts.in_window(df, start, end)


def next_window(spark: SparkSession, recorded: DataFrame | None, step: int,
                unit: str = "HOUR", pattern: str = HOUR_KEY,
                default_start: str = DEFAULT_START, now: datetime | None = None,
                guard: str = "start", end_col: str = "ENDTIME") -> DataFrame:
    """One row ``(STARTTIME, ENDTIME, STATUS)``.

    ``guard='start'`` (hour jobs): caught up when ``now - start < 1 hour``.
    ``guard='end'`` (minute jobs): caught up when ``now < end``.
    """
    if recorded is None:
        latest = spark.range(1).select(F.lit(None).cast("string").alias("M"))
    else:
        latest = recorded.agg(F.max(end_col).alias("M"))
    start = F.coalesce(F.col("M"), F.lit(default_start))
    end = add_to_key(start, unit, step, pattern)
    now_ms = F.lit(now_millis(now)).cast("bigint")
    if guard == "start":
        waiting = (now_ms - key_to_ms(start, pattern)) < MS_PER_HOUR
    elif guard == "end":
        waiting = now_ms < key_to_ms(end, pattern)
    else:
        raise ValueError(f"unknown guard {guard!r}")
    return latest.select(start.alias("STARTTIME"), end.alias("ENDTIME"),
                         F.when(waiting, "caught_up").otherwise("run").alias("STATUS"))


def window_ready(click, end: str, pattern: str = HOUR_KEY, gate: str = "next_hour",
                 time_col: str = "TIME") -> DataFrame:
    """One row ``READY``: has data arrived after the window?

    ``next_hour``: a row in ``[end, end + 1 hour)`` (the reference's rule;
    one empty hour stalls the job).  ``any_later``: any row at or after
    ``end``.  ``limit(1)`` lets the scan stop at the first match.
    """
    if gate == "next_hour":
        rows = rows_between(click, end, shift_key(end, pattern, "HOUR", 1))
    elif gate == "any_later":
        rows = rows_between(click, end, None)
    else:
        raise ValueError(f"unknown gate {gate!r}")
    return rows.select(F.lit(1).alias("x")).limit(1).agg(
        (F.count(F.lit(1)) > 0).alias("READY"))


class WindowStore:
    """Result rows and window markers, published together.

    Both are tables of one ``snapshots.Store``: a window's rows and its marker
    appear at once, readers see whole states only, and of two launches of the
    same window one is refused.

    Results are partitioned by the day of the window end (``END_DAY``), not
    by the window itself: a catch-up or a stream closing hundreds of hourly
    windows then writes a few dozen folders instead of one per window.  The
    store knows the window ends each folder holds, so the rows of a new window
    go into a folder of their own without reading the day; the folders of a
    day are merged when there are many.
    """

    PART = "END_DAY"
    RESULTS, MARKERS = "results", "markers"
    LAYOUT = Table(StructType(), (PART,), ("ENDTIME",))

    def __init__(self, root: str, table_name: str, keys: Sequence[str],
                 marker_in_results: bool = False, schema: str | None = None):
        self.root = root
        self.table_name = table_name
        self.keys = list(keys)
        # Parity with the reference: the marker is a row of the result table
        # itself (window columns set, the others null) and the next window is
        # read from the results.
        self.marker_in_results = marker_in_results
        # one folder per table: jobs that share a root never write the same one
        self.path = os.path.join(root, table_name)
        # columns of a result row, for a marker before any row was written
        self.schema = schema

    def store(self, spark: SparkSession) -> Store:
        return Store(spark, self.path)

    def markers(self, spark: SparkSession) -> DataFrame | None:
        table = self.RESULTS if self.marker_in_results else self.MARKERS
        store = self.store(spark)
        if store.table(table) is None:
            return None
        # a repeated launch may have added a window's marker twice
        columns = [f.name for f in MARKER_SCHEMA] if table == self.MARKERS else [
            "ENDTIME", "STARTTIME"]
        return store.read(table).select(*columns).distinct()

    def last_end(self, spark: SparkSession) -> str | None:
        """Greatest recorded window end, from the store's manifest (no file is
        read)."""
        return self.store(spark).greatest(
            self.RESULTS if self.marker_in_results else self.MARKERS, "ENDTIME")

    def results(self, spark: SparkSession, start: str | None = None, end: str | None = None
                ) -> DataFrame:
        """Result rows, optionally of windows that end in ``[start, end]`` (only
        folders that hold such ends are read)."""
        store = self.store(spark)
        if store.table(self.RESULTS) is None:
            raise FileNotFoundError(f"no results written yet under {self.path}")
        rows = store.read(self.RESULTS, lo=(start or "",), hi=None if end is None else (end,))
        for bound, op in ((start, ">="), (end, "<=")):
            if bound is not None:
                rows = rows.where(f"ENDTIME {op} '{bound}'")
        return rows.drop(self.PART)

    def write_results(self, spark: SparkSession, rows: DataFrame) -> None:
        """Upsert result rows without recording their windows."""
        self.publish(spark, rows)

    def publish(self, spark: SparkSession, rows: DataFrame | None = None,
                windows: DataFrame | None = None) -> None:
        """Upsert result rows and record windows (``ENDTIME, STARTTIME`` rows)
        in one step."""
        day = F.substring("ENDTIME", 1, 8)

        def body(tx):
            if rows is not None:
                tx.upsert(self.RESULTS, rows.withColumn(self.PART, day), self.keys,
                          self.LAYOUT, unique=True, fixed=True)
            if windows is None:
                return
            if self.marker_in_results:
                columns = tx.tables[self.RESULTS].schema if self.RESULTS in tx.tables else (
                    spark.createDataFrame([], self.schema).withColumn(self.PART, day).schema)
                marks = windows.select(*[
                    (day if f.name == self.PART else F.col(f.name)
                     if f.name in ("ENDTIME", "STARTTIME") else F.lit(None))
                    .cast(f.dataType).alias(f.name) for f in columns])
                tx.upsert(self.RESULTS, marks, self.keys, self.LAYOUT, unique=True, fixed=True)
            else:
                tx.append(self.MARKERS, windows.select(
                    F.lit(self.table_name).alias("TABLE_NAME"), "ENDTIME", "STARTTIME",
                    day.alias(self.PART)), self.LAYOUT)

        self.store(spark).run(body)

    def mark(self, spark: SparkSession, start: str, end: str) -> None:
        self.publish(spark, windows=one_window(spark, start, end))

    def mark_many(self, spark: SparkSession, windows: DataFrame) -> None:
        """Markers for many windows (``ENDTIME, STARTTIME`` rows)."""
        self.publish(spark, windows=windows)


def one_window(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.lit(end).alias("ENDTIME"),
                                          F.lit(start).alias("STARTTIME"))


def _recorded(spark: SparkSession, store: WindowStore) -> DataFrame | None:
    end = store.last_end(spark)
    return None if end is None else one_window(spark, "", end)


def run_window_job(spark: SparkSession, click, store: WindowStore, kind: str,
                   step: int, now: datetime | None = None, default_start: str = DEFAULT_START,
                   gate: str = "next_hour", unit: str = "HOUR", pattern: str = HOUR_KEY,
                   guard: str = "start", dims: Sequence[str] = counts.DIMENSIONS,
                   null_as_empty: bool = False) -> dict:
    """One launch of the label (``kind='label'``) or dimension job."""
    desc = next_window(spark, _recorded(spark, store), step, unit, pattern, default_start, now,
                       guard).first()
    start, end = desc["STARTTIME"], desc["ENDTIME"]
    if desc["STATUS"] != "run":
        return {"status": "caught_up", "start": start, "end": end}
    if not window_ready(click, end, pattern, gate).first()["READY"]:
        return {"status": "not_ready", "start": start, "end": end}
    # a time that is none (only its text lies in the window) is in no window;
    # the catch-up has the same rule
    window = rows_between(click, start, end).where(
        key_to_ms(F.substring("TIME", 1, 10), HOUR_KEY).isNotNull())
    if kind == "label":
        rows = counts.label_pv_window(window, start, end, null_as_empty=null_as_empty)
    elif kind == "dim":
        rows = counts.dim_pv_window(window, start, end, dims)
    else:
        raise ValueError(f"unknown job kind {kind!r}")
    store.publish(spark, rows, one_window(spark, start, end))
    return {"status": "done", "start": start, "end": end}


def run_catch_up(spark: SparkSession, source, store: WindowStore, kind: str, step: int,
                 now: datetime | None = None, default_start: str = DEFAULT_START,
                 gate: str = "next_hour", dims: Sequence[str] = counts.DIMENSIONS) -> dict:
    """Every ready window after the last recorded one, in one pass.

    Same windows as repeated ``run_window_job`` launches (the same gate and
    guard, stopping at the first window that is not ready), but one scan of
    the source from the recorded start: a scheduler that missed many hours
    catches up in one run.  Rows are upserted first, then every ready window
    is marked -- including windows that produced no rows.
    """
    from clickwin.plans import backfill as bf

    desc = next_window(spark, _recorded(spark, store), step, "HOUR", HOUR_KEY, default_start,
                       now, "start").first()
    start = desc["STARTTIME"]
    if desc["STATUS"] != "run":
        return {"status": "caught_up", "start": start, "windows": 0}
    click = rows_between(source, start, None)
    if kind == "label":
        rows, windows = bf.label_parts(click, start, step, now, gate)
    elif kind == "dim":
        rows, windows = bf.dim_parts(click, start, step, dims, now, gate)
    else:
        raise ValueError(f"unknown job kind {kind!r}")
    # one small row to the driver: how many windows, and the last end
    summary = windows.agg(F.count(F.lit(1)).alias("n"), F.max("ENDTIME").alias("end")).first()
    if summary["n"] == 0:
        return {"status": "not_ready", "start": start, "windows": 0}
    store.publish(spark, rows, windows)
    return {"status": "done", "start": start, "end": summary["end"],
            "windows": int(summary["n"])}


def label_store(root: str, marker_in_results: bool = False) -> WindowStore:
    return WindowStore(root, "STAT_LABEL", ["ENDTIME", "WORD"], marker_in_results,
                       "ENDTIME string, STARTTIME string, WORD string, FREQUENCY bigint")


def dim_store(root: str, dims: Sequence[str] = counts.DIMENSIONS,
              marker_in_results: bool = False) -> WindowStore:
    columns = ", ".join(f"{d} string" for d in dims)
    return WindowStore(root, "STAT_PARAMTYPE_CONTENTTYPE", ["ENDTIME", *dims], marker_in_results,
                       f"ENDTIME string, STARTTIME string, {columns}, FREQUENCY bigint")


def copy_window(spark: SparkSession, src, dst_path: str, columns: Sequence[str],
                start: str, end: str, keys: Sequence[str] = ("ID",),
                by_day: bool = True, time_col: str = "TIME", unique: bool = False) -> None:
    """Upsert a projected time slice of one table into another.

    Scan (window pushed down) -> project -> write.  ``unique`` says that the
    source holds one row per key: then days that are new in the target cost
    no shuffle but the one that gathers a day's rows into few files.  With ``by_day``
    the target is partitioned by the day of ``TIME`` and only the day folders
    of ``[start, end)`` are read and merged, so copying one hour into a large
    table costs one day, not the table.  (A key never changes day: an event
    keeps its time.)
    """
    rows = rows_between(src, start, end).select(*columns)
    if not by_day:
        up.write_upsert(spark, dst_path, rows, list(keys), unique=unique)
        return
    from datetime import timedelta

    from clickwin.sources.clicklog import DAY_PARTITION, key_start
    rows = rows.withColumn(DAY_PARTITION, F.substring(time_col, 1, 8))
    days, d, last = [], key_start(start[:8]), key_start(end[:8])
    while d <= last:
        days.append(d.strftime("%Y%m%d"))
        d += timedelta(days=1)
    up.write_upsert(spark, dst_path, rows, list(keys), partition_by=[DAY_PARTITION],
                    partition_values=days, unique=unique)


__all__ = ["next_window", "window_ready", "WindowStore", "run_window_job", "label_store",
           "dim_store", "copy_window", "MINUTE_KEY"]
