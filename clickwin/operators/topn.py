"""Top-N per group, top-1, limits, existence probes and one-value lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_n_per_group(df: DataFrame, group: str | Sequence[str], order_desc: str,
                       n: int = 3, tie_break: str | Sequence[str] | None = None,
                       rank_col: str = "rank") -> DataFrame:
    """The ``n`` rows with the greatest ``order_desc`` in each group.

    ``row_number`` + ``rank <= n`` lets Spark plan a partial
    ``WindowGroupLimit`` before the shuffle: each map task forwards at most
    ``n`` rows per group, so a group holding a third of the table ships ``n``
    rows per task, not a third of the table.  ``tie_break`` makes the choice
    among equal times deterministic.
    """
    groups = [group] if isinstance(group, str) else list(group)
    ties = [] if tie_break is None else ([tie_break] if isinstance(tie_break, str)
                                         else list(tie_break))
    w = Window.partitionBy(*groups).orderBy(F.col(order_desc).desc(), *[F.col(t) for t in ties])
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def sort_desc(df: DataFrame, col: str, *then: str) -> DataFrame:
    """Global sort, descending (range-partitioned sort, no single task)."""
    return df.orderBy(F.col(col).desc(), *[F.col(c) for c in then])


def top_one(df: DataFrame, col: str) -> DataFrame:
    """``ORDER BY col DESC LIMIT 1`` (``TakeOrderedAndProject``: each task
    keeps its best row, the driver-side merge sees one row per task)."""
    return df.orderBy(F.col(col).desc_nulls_last()).limit(1)


def limit_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows in a stated order (a limit is only deterministic after
    an order)."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def range_exists(df: DataFrame, cond: Column, out: str = "EXISTS") -> DataFrame:
    """One row with a flag: does any row satisfy ``cond``?

    A filtered ``limit(1)`` stops scanning early; as a DataFrame result the
    aggregate form keeps one row even when nothing matches.
    """
    return df.where(cond).select(F.lit(1).alias("_x")).limit(1).agg(
        (F.count(F.lit(1)) > 0).alias(out))


def lookup_first(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """First row's first column, null when empty (one-row DataFrame)."""
    first = df.select(F.col(col).alias(out or col)).limit(1)
    return first.agg(F.first(out or col, ignorenulls=False).alias(out or col))


def lookup_exactly_one(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Value only when the query returns exactly one row, else null."""
    name = out or col
    # Two rows are enough to know "not exactly one".
    two = df.select(F.col(col).alias(name)).limit(2)
    return two.agg(F.when(F.count(F.lit(1)) == 1, F.first(name)).alias(name))


def lookup_object(df: DataFrame, record, out: str = "R") -> DataFrame:
    """One typed record when the query returns exactly one row, else null.

    ``record`` is a column expression building the record (for example
    ``functions.records.map_to_struct(...)``); the result has one row.
    """
    two = df.select(record.alias(out)).limit(2)
    return two.agg(F.when(F.count(F.lit(1)) == 1, F.first(out)).alias(out))
