"""The click log and its cell-store form, derived from ``events``.

``clicklog`` gives the columns the page-view jobs read (``ID, TIME, UDID,
PLATFORM, PARAM_TYPE, CONTENT_TYPE, URL, TITLE, CONTENT_LABEL``).  ``TIME``
is a 17-digit ``yyyyMMddHHmmssSSS`` key.  ``cells`` is the long
``(rowkey, family, qualifier, value)`` form of the same rows, the shape a
sparse key-sorted cell table has.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwin.functions.timekeys import MILLI_KEY

RANGE_BYTES = 64 << 20     # of text that one task sorts

CLICK_COLUMNS = ["ID", "TIME", "UDID", "PLATFORM", "PARAM_TYPE", "CONTENT_TYPE",
                 "URL", "TITLE", "CONTENT_LABEL"]
CELL_QUALIFIERS = ["ID", "TIME", "UDID", "PLATFORM", "PARAM_TYPE", "CONTENT_TYPE",
                   "URL", "TITLE", "CONTENT_LABEL"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def clicklog_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Click-log rows built column by column from ``events``.

    Pure projection: no shuffle, and Catalyst prunes the scan to
    ``event_id, ts, user_id, event_type`` (or fewer, when a caller selects
    fewer columns).  ``keep`` passes extra ``events`` columns through.
    """
    eid = F.col("event_id")
    uid = F.col("user_id")
    et = F.col("event_type")
    s = lambda c: c.cast("string")
    label = (F.when(eid % 7 == 0, F.lit(None).cast("string"))
             .when(eid % 7 == 1, F.lit(""))
             .when(eid % 7 == 2, F.lit(","))
             .when(eid % 7 == 3, F.concat(et, F.lit(",,")))
             .when(eid % 7 == 4, F.concat(F.lit(","), et))
             .otherwise(F.concat(et, F.lit(",u"), s(uid % 10), F.lit(","), et)))
    return events.select(
        *keep,
        s(eid).alias("ID"),
        F.date_format("ts", MILLI_KEY).alias("TIME"),
        # lpad alone would cut longer ids to four characters
        F.lpad(s(uid), F.greatest(F.length(s(uid)), F.lit(4)), F.lit("0")).alias("UDID"),
        F.when(uid % 3 == 0, "ios").when(uid % 3 == 1, "android").alias("PLATFORM"),
        F.concat(F.lit("p"), s(eid % 4)).alias("PARAM_TYPE"),
        et.alias("CONTENT_TYPE"),
        F.concat(F.lit("/"), et, F.lit("/"), s(uid)).alias("URL"),
        F.concat(et, F.lit("-"), s(eid)).alias("TITLE"),
        label.alias("CONTENT_LABEL"),
    )


_KEY_FORMATS = {8: "%Y%m%d", 10: "%Y%m%d%H", 12: "%Y%m%d%H%M", 14: "%Y%m%d%H%M%S"}


def key_start(key: str):
    """The instant a time key starts at (driver-side, for one bound).

    Keys are prefixes of ``yyyyMMddHHmmssSSS``: ``TIME >= key`` holds exactly
    when the event time is at or after this instant, and ``TIME < key`` when
    it is before it.
    """
    from datetime import datetime, timedelta
    if len(key) == 17:
        return datetime.strptime(key[:14], _KEY_FORMATS[14]) + timedelta(
            milliseconds=int(key[14:]))
    return datetime.strptime(key, _KEY_FORMATS[len(key)])


def events_between(events: DataFrame, start: str | None, end: str | None,
                   ts_col: str = "ts") -> DataFrame:
    """Events whose derived ``TIME`` lies in ``[start, end)``, filtered on the
    stored event time so the bounds reach the Parquet scan (``PushedFilters``
    on ``ts``; row groups outside the range are skipped)."""
    cond = None
    for bound, op in ((start, "__ge__"), (end, "__lt__")):
        if bound is None:
            continue
        try:
            at = key_start(bound)
        except (KeyError, ValueError):
            # a bound of another width is still a valid string bound on TIME
            # (applied by the window filter); it just is not pushed down
            continue
        lit = F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
        c = getattr(F.col(ts_col), op)(lit)
        cond = c if cond is None else cond & c
    return events if cond is None else events.where(cond)


def clicklog(spark: SparkSession, sf_dir: str, start: str | None = None,
             end: str | None = None) -> DataFrame:
    """The click log of ``sf_dir``'s events, optionally only ``[start, end)``."""
    return clicklog_from_events(events_between(load(spark, sf_dir, "events"), start, end))


def rows_to_cells(df: DataFrame, rowkey: str = "rowkey", columns: list[str] | None = None,
                  family: str = "info", null_text: str | None = None) -> DataFrame:
    """Wide rows -> ``(rowkey, family, qualifier, value)`` cells.

    ``unpivot`` is a narrow ``Expand``: no shuffle.  A null value is an
    absent cell unless ``null_text`` is given (the reference's cell writer
    stores the text ``null``).
    """
    cols = columns or [c for c in df.columns if c != rowkey]
    long = df.unpivot([rowkey], [F.col(c).cast("string").alias(c) for c in cols],
                      "qualifier", "value")
    if null_text is None:
        long = long.where(F.col("value").isNotNull())
    else:
        long = long.withColumn("value", F.coalesce("value", F.lit(null_text)))
    return long.select(F.col(rowkey).alias("rowkey"), F.lit(family).alias("family"),
                       "qualifier", "value")


def cells_from_clicklog(click: DataFrame, family: str = "info") -> DataFrame:
    """Cells keyed by ``UDID_TIME_ID`` (device, 17-digit time, event): two
    events of a device in the same millisecond are two rows."""
    keyed = click.select(F.concat_ws("_", "UDID", "TIME", "ID").alias("rowkey"),
                         *CELL_QUALIFIERS)
    return rows_to_cells(keyed, "rowkey", CELL_QUALIFIERS, family)


def ranges_of(rows: DataFrame, each: int = RANGE_BYTES) -> int:
    """How many ranges of about ``each`` bytes the rows make (one pass, no
    exchange).  Without a number Spark makes as many ranges as the session has
    shuffle partitions, or fewer: then a range, which one task sorts, grows
    with the table."""
    width = sum(F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
                for c in rows.columns)
    size = rows.agg(F.sum(width)).first()[0]
    return max(1, -(-(size or 0) // each))


def write_sorted_cells(cells_df: DataFrame, path: str, num_partitions: int | None = None) -> None:
    """Store cells range-partitioned and sorted by row key.

    Sorted files make each Parquet row group cover a narrow key range, so a
    later ``[start, stop)`` row-key scan skips most row groups via min/max
    statistics (the cell store's key-range scan).  Without ``num_partitions``
    their number follows from the bytes.
    """
    # qualifier breaks ties, so one very wide row spreads over several tasks
    ranges = ["rowkey", "qualifier"]
    (cells_df.repartitionByRange(num_partitions or ranges_of(cells_df), *ranges)
     .sortWithinPartitions("rowkey", "family", "qualifier")
     .write.mode("overwrite").parquet(path))


# Stored click-log layout: one folder per day of TIME, files sorted by TIME.
DAY_PARTITION = "DAY"


def write_clicklog(click: DataFrame, path: str, num_partitions: int | None = None,
                   mode: str = "overwrite", tie_break: str | None = "ID") -> None:
    """Store a click log partitioned by day and sorted by ``TIME``.

    Rows are range-partitioned on ``TIME`` first: each task writes a
    contiguous time range (a busy day is split over many tasks instead of
    landing in one), and sorted files let Parquet row-group statistics skip
    everything outside an hour window.  ``dynamic`` overwrite replaces only
    the days present in ``click``.
    """
    n = num_partitions or ranges_of(click)
    # the tie-break column splits a burst of equal TIME values over tasks
    order = ["TIME"] + ([tie_break] if tie_break and tie_break in click.columns else [])
    (click.withColumn(DAY_PARTITION, F.substring("TIME", 1, 8))
     .repartitionByRange(n, *order).sortWithinPartitions(*order)
     .write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(DAY_PARTITION).parquet(path))


def read_clicklog(spark: SparkSession, path: str, start: str | None = None,
                  end: str | None = None) -> DataFrame:
    """Read a stored click log; ``DAY`` stays a string partition column.

    With both bounds only the day folders of ``[start, end)`` are listed and
    read (a log of many years is never listed whole for a one-hour job).
    Window filters from ``operators.counts.in_window`` also add the matching
    ``DAY`` predicate, so a full read is pruned the same way.
    """
    from datetime import timedelta

    from clickwin.operators.upsert import path_exists, read_partitions, read_table
    if start is not None and end is not None:
        d, last = key_start(start[:8]), key_start(end[:8])
        dirs = []
        while d <= last:
            folder = f"{path.rstrip('/')}/{DAY_PARTITION}={d.strftime('%Y%m%d')}"
            if path_exists(spark, folder):
                dirs.append(folder)
            d += timedelta(days=1)
        if dirs:
            return read_partitions(spark, path, DAY_PARTITION, dirs)
    return read_table(spark, path, [DAY_PARTITION])
