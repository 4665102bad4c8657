"""Catch-up: every ready window in one pass, no driver loop over windows.

The one-window-per-launch job starts at ``default_start``, runs window
``i = [S + i*h, S + (i+1)*h)`` (hours) only when data exists in the hour
after it (the completeness gate) and when ``now - start >= 1 hour`` (the
guard), and stops at the first window that fails.  Repeated launches thus
produce exactly the windows ``0 .. f-1`` where ``f`` is the first failing
window.  This module computes the same rows with one aggregation:

1. group the rows by ``(hour key, result key)`` -- partial aggregation on
   the map side, so the shuffle carries at most one row per hour and key
   per task, however hot a key is;
2. from the hours present (a few thousand per year, not per row) derive
   the ready windows and ``f`` = the smallest window index that is not
   ready (it is 0 or the successor of a ready window);
3. keep hours of windows below ``f`` and re-aggregate to window grain.

Time keys are only parsed after step 1, once per hour, never per row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwin.functions.labels import split_labels
from clickwin.functions.timekeys import HOUR_KEY, key_to_ts, now_millis
from clickwin.operators.counts import in_window
from clickwin.session import materialize as materialize_table

MS_PER_HOUR = 3_600_000


def key_millis(key: str, tz: str = "UTC", pattern: str = "%Y%m%d%H") -> int:
    """Epoch ms of a time key read in the session time zone (driver-side,
    for one constant)."""
    from zoneinfo import ZoneInfo
    return int(datetime.strptime(key, pattern).replace(tzinfo=ZoneInfo(tz)).timestamp() * 1000)


def _hour_index(hour_key: Column, start: str) -> Column:
    """Whole hours between ``start`` and an hour key (both ``yyyyMMddHH``)."""
    start_ms = F.unix_millis(key_to_ts(F.lit(start), HOUR_KEY))
    return ((F.unix_millis(key_to_ts(hour_key, HOUR_KEY)) - start_ms) / F.lit(MS_PER_HOUR)
            ).cast("bigint")


def _window_key(start: str, hours: Column) -> Column:
    return F.date_format(F.timestamp_add("HOUR", hours, key_to_ts(F.lit(start), HOUR_KEY)),
                         HOUR_KEY)


def hourly_counts(df: DataFrame, start: str, keys: Callable[[DataFrame], DataFrame],
                  time_col: str = "TIME") -> DataFrame:
    """``(HOUR, *keys, N)``; ``keys`` maps rows to key columns (may explode)."""
    rows = in_window(df, start, None, time_col).withColumn(
        "HOUR", F.substring(F.col(time_col), 1, 10))
    keyed = keys(rows)
    return keyed.groupBy("HOUR", *[c for c in keyed.columns if c != "HOUR"]).agg(
        F.count(F.lit(1)).alias("N"))


def ready_limit(hours_present: DataFrame, step_hours: int, start: str,
                now: datetime | None = None, gate: str = "next_hour") -> Column:
    """Scalar-subquery column: number of windows the launches would run.

    ``hours_present`` has one column ``K`` (hour index, may repeat).
    ``gate='next_hour'`` needs data in the hour right after the window;
    ``gate='any_later'`` needs any data at or after the window end.
    """
    h = int(step_hours)
    ks = hours_present.select("K").where(F.col("K") >= 0)
    spark = ks.sparkSession
    if gate == "next_hour":
        ready = ks.where((F.col("K") % h == 0) & (F.col("K") >= h)).select(
            (F.col("K") / h - 1).cast("bigint").alias("I"))
        # f = the smallest i >= 0 that is not ready; it is 0 or ready + 1.
        # One grouped pass over (value, is_ready, is_candidate) flags, no join.
        flags = (ready.select(F.col("I").alias("V"), F.lit(1).alias("R"), F.lit(0).alias("C"))
                 .unionByName(ready.select((F.col("I") + 1).alias("V"), F.lit(0).alias("R"),
                                           F.lit(1).alias("C")))
                 .unionByName(spark.range(1).select(F.lit(0).cast("bigint").alias("V"),
                                                    F.lit(0).alias("R"), F.lit(1).alias("C"))))
        first_gap = (flags.groupBy("V").agg(F.max("R").alias("R"), F.max("C").alias("C"))
                     .where((F.col("C") == 1) & (F.col("R") == 0)).agg(F.min("V").alias("F")))
    elif gate == "any_later":
        # window i is ready when some hour >= (i+1)*h is present, so the ready
        # windows are exactly 0 .. floor(max_hour / h) - 1
        first_gap = ks.agg(F.coalesce(F.floor(F.max("K") / h), F.lit(0)).cast("bigint")
                           .alias("F"))
    else:
        raise ValueError(f"unknown gate {gate!r}")
    # guard: window i runs only if now - start_i >= 1 hour
    start_ms = key_millis(start, spark.conf.get("spark.sql.session.timeZone"))
    guard = (now_millis(now) - MS_PER_HOUR - start_ms) // (h * MS_PER_HOUR) + 1
    return F.least(first_gap.scalar(), F.lit(max(guard, 0)).cast("bigint"))


def backfill(df: DataFrame, start: str, step_hours: int,
             keys: Callable[[DataFrame], DataFrame], count_filter: Column | None = None,
             now: datetime | None = None, gate: str = "next_hour",
             time_col: str = "TIME", materialize: bool = True) -> DataFrame:
    """All ready windows: ``(ENDTIME, STARTTIME, *keys, FREQUENCY)``.

    ``materialize`` writes the hour-grain aggregate once as a table in
    ``spark.checkpoint.dir`` and reads it back.  The big table is then
    scanned exactly once; the readiness subquery and the final roll-up read
    the small table, and a lost executor never forces a rescan of the
    source.  It also keeps Catalyst from pushing the window-limit predicate
    (a function of the hour key) below the aggregate, where it would be
    evaluated once per row.
    """
    return backfill_parts(df, start, step_hours, keys, count_filter, now, gate, time_col,
                          materialize)[0]


def backfill_parts(df: DataFrame, start: str, step_hours: int,
                   keys: Callable[[DataFrame], DataFrame], count_filter: Column | None = None,
                   now: datetime | None = None, gate: str = "next_hour",
                   time_col: str = "TIME", materialize: bool = True
                   ) -> tuple[DataFrame, DataFrame]:
    """``(rows, windows)``: the result rows and every ready window
    ``(ENDTIME, STARTTIME)`` -- also those without rows, so each can be
    marked done.  The window list has one row per window (bounded by the time
    span, not by the data)."""
    h = int(step_hours)
    hourly = hourly_counts(df, start, keys, time_col)
    if materialize:
        hourly = materialize_table(hourly, "hourly")
    hourly = hourly.withColumn("K", _hour_index(F.col("HOUR"), start)).where(
        F.col("K").isNotNull())
    limit = ready_limit(hourly.select("K"), h, start, now, gate)
    rows = _rollup(hourly, start, h, limit, count_filter)
    spark = df.sparkSession
    windows = (spark.range(1)
               .select(F.explode(F.when(limit > 0, F.sequence(F.lit(0).cast("bigint"),
                                                              limit - 1))).alias("W"))
               .select(_window_key(start, (F.col("W") + 1) * h).alias("ENDTIME"),
                       _window_key(start, F.col("W") * h).alias("STARTTIME")))
    return rows, windows


def _rollup(hourly: DataFrame, start: str, h: int, limit: Column,
            count_filter: Column | None) -> DataFrame:
    key_cols = [c for c in hourly.columns if c not in ("HOUR", "N", "K")]
    kept = hourly.where((F.col("K") >= 0) & (F.floor(F.col("K") / h) < limit))
    if count_filter is not None:
        kept = kept.where(count_filter)
    w = F.floor(F.col("K") / h).cast("bigint")
    out = (kept.withColumn("W", w).groupBy("W", *key_cols)
           .agg(F.sum("N").alias("FREQUENCY")))
    return out.select(_window_key(start, (F.col("W") + 1) * h).alias("ENDTIME"),
                      _window_key(start, F.col("W") * h).alias("STARTTIME"),
                      *key_cols, "FREQUENCY")


def label_keys(label_col: str = "CONTENT_LABEL") -> Callable[[DataFrame], DataFrame]:
    """Rows -> ``(HOUR, WORD)``; rows without any label (null, or only commas)
    give WORD null, so their hour still counts as present for the gate."""
    def f(rows: DataFrame) -> DataFrame:
        return rows.select("HOUR", F.explode_outer(split_labels(label_col)).alias("WORD"))
    return f


def label_parts(df: DataFrame, start: str, step_hours: int, now: datetime | None = None,
                gate: str = "next_hour") -> tuple[DataFrame, DataFrame]:
    return backfill_parts(df, start, step_hours, label_keys(), F.col("WORD").isNotNull(),
                          now, gate)


def dim_parts(df: DataFrame, start: str, step_hours: int,
              dims: Sequence[str] = ("PLATFORM", "PARAM_TYPE", "CONTENT_TYPE"),
              now: datetime | None = None, gate: str = "next_hour"
              ) -> tuple[DataFrame, DataFrame]:
    return backfill_parts(df, start, step_hours, lambda r: r.select("HOUR", *dims), None,
                          now, gate)


def label_backfill(df: DataFrame, start: str, step_hours: int, now: datetime | None = None,
                   gate: str = "next_hour", materialize: bool = True) -> DataFrame:
    return backfill(df, start, step_hours, label_keys(), F.col("WORD").isNotNull(), now, gate,
                    materialize=materialize)


def dim_backfill(df: DataFrame, start: str, step_hours: int,
                 dims: Sequence[str] = ("PLATFORM", "PARAM_TYPE", "CONTENT_TYPE"),
                 now: datetime | None = None, gate: str = "next_hour",
                 materialize: bool = True) -> DataFrame:
    return backfill(df, start, step_hours, lambda r: r.select("HOUR", *dims), None, now, gate,
                    materialize=materialize)
