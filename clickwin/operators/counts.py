"""Page-view counts: labels per window, dimension combinations per window.

Both are a filter on the string time key (pushed to the scan), a narrow
projection, and one ``groupBy`` count.  Spark plans the count as a partial
aggregate before the shuffle and a final one after it, so a label or
dimension group holding a third of all rows is reduced to one row per map
task before anything moves: hot keys cost no more than cold ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwin.functions.labels import split_labels
from clickwin.functions.timekeys import key_range

DIMENSIONS = ("PLATFORM", "PARAM_TYPE", "CONTENT_TYPE")


DAY_PARTITION = "DAY"


def in_window(df: DataFrame, start: str | None, end: str | None, time_col: str = "TIME"
              ) -> DataFrame:
    """Rows with ``start <= time < end`` (string compare; prefix bounds work).

    On a log stored by day (``sources.clicklog.write_clicklog``) the implied
    ``DAY`` range is added too: Spark cannot derive it from the ``TIME``
    bounds, and it is what prunes whole day folders from the scan.
    """
    if start is None and end is None:
        return df
    cond = key_range(time_col, start, end)
    if DAY_PARTITION in df.columns:
        if start is not None:
            cond = cond & (F.col(DAY_PARTITION) >= F.lit(start[:8]))
        if end is not None:
            cond = cond & (F.col(DAY_PARTITION) <= F.lit(end[:8]))
    return df.where(cond)


def label_counts(df: DataFrame, start: str | None = None, end: str | None = None,
                 time_col: str = "TIME", label_col: str = "CONTENT_LABEL",
                 null_as_empty: bool = False, word: str = "WORD",
                 freq: str = "FREQUENCY") -> DataFrame:
    """How often each comma-separated label occurs in ``[start, end)``.

    Null labels are skipped; with ``null_as_empty`` they count as the empty
    label instead (the minute-grain job's rule).
    """
    rows = in_window(df, start, end, time_col)
    if null_as_empty:
        labels = F.coalesce(F.col(label_col), F.lit(""))
    else:
        rows = rows.where(F.col(label_col).isNotNull())
        labels = F.col(label_col)
    return (rows.select(F.explode(split_labels(labels)).alias(word))
            .groupBy(word).agg(F.count(F.lit(1)).alias(freq)))


def label_counts_by_day(df: DataFrame, start: str | None = None, end: str | None = None,
                        time_col: str = "TIME", label_col: str = "CONTENT_LABEL") -> DataFrame:
    """Label counts of every day of ``[start, end)``: ``(TIME, WORD, FREQUENCY)``."""
    rows = in_window(df, start, end, time_col).where(F.col(label_col).isNotNull())
    return (rows.select(F.substring(time_col, 1, 8).alias("TIME"),
                        F.explode(split_labels(label_col)).alias("WORD"))
            .groupBy("TIME", "WORD").agg(F.count(F.lit(1)).alias("FREQUENCY")))


def dim_counts(df: DataFrame, start: str | None = None, end: str | None = None,
               dims: Sequence[str] = DIMENSIONS, time_col: str = "TIME",
               freq: str = "FREQUENCY") -> DataFrame:
    """``COUNT(*)`` per dimension combination in ``[start, end)``; a null is a
    group of its own."""
    return (in_window(df, start, end, time_col)
            .groupBy(*dims).agg(F.count(F.lit(1)).alias(freq)))


def tag_window(df: DataFrame, start: str, end: str, end_col: str = "ENDTIME",
               start_col: str = "STARTTIME") -> DataFrame:
    """Prefix the window bounds as constant columns (folded by Catalyst)."""
    return df.select(F.lit(end).alias(end_col), F.lit(start).alias(start_col), "*")


def label_pv_window(df: DataFrame, start: str, end: str, **kw) -> DataFrame:
    """Label result rows ``(ENDTIME, STARTTIME, WORD, FREQUENCY)``."""
    return tag_window(label_counts(df, start, end, **kw), start, end)


def dim_pv_window(df: DataFrame, start: str, end: str, dims: Sequence[str] = DIMENSIONS
                  ) -> DataFrame:
    """Dimension result rows ``(ENDTIME, STARTTIME, *dims, FREQUENCY)``."""
    return tag_window(dim_counts(df, start, end, dims), start, end)


def row_count(df: DataFrame, out: str = "n") -> DataFrame:
    """One-row count (partial counts per task, one final sum)."""
    return df.agg(F.count(F.lit(1)).alias(out))


def max_value(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Greatest value of a column as a one-row DataFrame (null when empty).

    ``max`` is a partial + final aggregate; ``ORDER BY .. DESC LIMIT 1``
    gives the same value via a top-k but ``max`` is cheaper.
    """
    return df.agg(F.max(col).alias(out or col))

