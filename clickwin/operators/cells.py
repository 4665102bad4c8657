"""Cell-store operators over the long form ``(rowkey, family, qualifier, value)``.

A cell table is sparse (rows differ in their cells) and sorted by row key.
Row-key range scans are string ranges on ``rowkey`` pushed into the
Parquet scan; when the files were written sorted by row key
(``sources.clicklog.write_sorted_cells``) row-group statistics skip all
groups outside the range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickwin.functions.timekeys import key_range
from clickwin.sources.clicklog import rows_to_cells  # noqa: F401  (re-export: K3)


def scan_key_range(cells: DataFrame, start: str | None, stop: str | None,
                   family: str | None = "info") -> DataFrame:
    """Cells with ``start <= rowkey < stop`` in one column family."""
    out = cells.where(key_range("rowkey", start, stop))
    if family is not None:
        out = out.where(F.col("family") == family)
    return out


def scan_qualifier(cells: DataFrame, family: str, qualifier: str) -> DataFrame:
    """Only ``family:qualifier`` cells."""
    return cells.where((F.col("family") == family) & (F.col("qualifier") == qualifier))


def project_rowkey(cells: DataFrame) -> DataFrame:
    """Distinct row keys of a scan (one per row)."""
    return cells.select("rowkey").distinct()


def cells_to_map(cells: DataFrame, drop_last: bool = False, out: str = "cells") -> DataFrame:
    """One row per row key and family: ``qualifier -> value`` map sorted by
    qualifier.

    Equal cells count once; of several values of a cell the greatest stays
    (cells carry no version).  A group is one record's distinct cells, bounded
    by the record width; tables with rows of unbounded width go through
    ``cells_of_rows_with_n`` first.  ``drop_last=True`` omits the greatest
    qualifier, as the reference's conversion loop did.
    """
    entries = F.array_sort(F.collect_set(F.struct("qualifier", "value")))
    entries = F.filter(entries, lambda e, i: F.coalesce(
        F.get(entries, i + 1)["qualifier"] != e["qualifier"], F.lit(True)))
    if drop_last:
        entries = F.slice(entries, 1, F.greatest(F.size(entries) - 1, F.lit(0)))
    return (cells.groupBy("rowkey", "family").agg(F.map_from_entries(entries).alias(out))
            .drop("family"))


def filter_cell_count(maps: DataFrame, n: int, col: str = "cells") -> DataFrame:
    """Rows holding exactly ``n`` cells (on rows already turned into maps)."""
    return maps.where(F.size(col) == n)


def cells_of_rows_with_n(cells: DataFrame, n: int) -> DataFrame:
    """Cells of the rows that hold exactly ``n`` different qualifiers in a
    family, before any row is assembled.

    Cells are exchanged by row key once and counted there by a window (which
    spills), so the source is read once and ``cells_to_map`` reuses the
    partitioning; only rows that pass are then gathered into maps.
    """
    row = ["rowkey", "family"]
    # the running number of different qualifiers; its greatest value is their count
    number = F.dense_rank().over(Window.partitionBy(*row).orderBy("qualifier"))
    count = F.max("_q").over(Window.partitionBy(*row))
    return (cells.withColumn("_q", number).withColumn("_n", count).where(F.col("_n") == n)
            .drop("_q", "_n"))


def cells_to_wide(maps: DataFrame, n_cells: int, width: int, col: str = "cells",
                  prefix: str = "col") -> DataFrame:
    """Positional wide row: values in qualifier order as ``col1..col{width}``;
    columns past the last cell repeat the last value."""
    vals = F.map_values(col)
    return maps.select(*[vals.getItem(min(i, n_cells - 1)).alias(f"{prefix}{i + 1}")
                         for i in range(width)])
