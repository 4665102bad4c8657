"""A stored cell table split into key regions.

Cells ``(rowkey, family, qualifier, value)`` lie in regions: contiguous ranges
of ``(rowkey, qualifier)``, each a folder of files sorted by key (the qualifier
lets a row of unbounded width span regions).  The bounds of all regions are in
the store's manifest, so

* a key-range scan lists and reads only regions that meet the range, and
  skips row groups inside them;
* an upsert rewrites only the regions that its keys fall into, and leaves
  their files sorted;
* a region holds about ``region_bytes`` of cells, so that the task which sorts
  it needs the same memory however many cells there are: a load counts their
  bytes first, and a region grown beyond twice that is split by a sampled
  range partitioning of its own rows.

States are published by ``snapshots.Store``: readers never see half a write.
"""

from __future__ import annotations

import json
from math import ceil, isqrt
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickwin.functions.timekeys import key_range
from clickwin.operators import upsert as up
from clickwin.sources.clicklog import ranges_of
from clickwin.sources.snapshots import Segment, Store, Table, Transaction

KEYS = ["rowkey", "family", "qualifier"]
ZONE = ["rowkey", "qualifier"]
REGION = "REGION"
REGION_BYTES = 64 << 20    # of cells as text
PACKED = 8                  # bytes of text in a byte of a sorted file, about
_TABLE = "cells"
LAYOUT = Table(StructType(), (REGION,), tuple(ZONE), tuple(KEYS), True)


def region_of(bounds: list[tuple], labels: list[str]) -> Column:
    """The label of the region a cell's key falls into.

    ``bounds`` are the least keys of all regions but the first, in order.  A
    row is compared with the heads of about sqrt(n) groups of bounds, then with
    the bounds of one group.
    """
    if not bounds:
        return F.lit(labels[0])
    step = max(1, isqrt(len(bounds)))
    groups = [[{"r": r, "q": q} for r, q in bounds[i:i + step]]
              for i in range(0, len(bounds), step)]
    # constants as text that is parsed once, not as an expression a value
    def constant(value, kind):
        return F.from_json(F.lit(json.dumps(value)), kind)

    key = F.struct(F.col("rowkey").alias("r"), F.col("qualifier").alias("q"))
    pair = "struct<r:string,q:string>"
    heads = constant([g[0] for g in groups], f"array<{pair}>")
    passed = F.size(F.filter(heads, lambda s: s <= key))            # groups begun
    group = F.get(constant(groups, f"array<array<{pair}>>"), passed - 1)
    at = F.when(passed == 0, 0).otherwise(
        (passed - 1) * step + F.size(F.filter(group, lambda s: s <= key)))
    return F.get(constant(labels, "array<string>"), at)


class CellStore:
    def __init__(self, spark: SparkSession, root: str, region_bytes: int = REGION_BYTES):
        self.spark, self.store, self.region_bytes = spark, Store(spark, root), region_bytes

    def regions(self) -> list[Segment]:
        """All regions' folders by their least key."""
        table = self.store.table(_TABLE)
        return sorted(table.segments, key=lambda s: s.lo) if table else []

    def load(self, cells: DataFrame, unique: bool = False, regions: int | None = None) -> int:
        """Store the cells of a new table (one value a key: the greatest, unless
        ``unique`` says there is just one); returns how many.  Without
        ``regions`` their number follows from the bytes."""
        if self.regions():
            raise ValueError(f"{self.store.root} holds cells already: use upsert")
        rows = cells.select(*KEYS, "value")
        regions = regions or ranges_of(rows, self.region_bytes)
        rows = rows if unique else up.dedupe_latest(rows, KEYS)
        return self.store.run(lambda tx: tx.append(
            _TABLE, self._split(rows, regions), LAYOUT, placed=True))

    def _split(self, rows: DataFrame, regions: int) -> DataFrame:
        """Rows by sampled ranges of their keys, one region a task."""
        ranged = rows.repartitionByRange(regions, *ZONE)
        name = F.concat(F.lit(uuid4().hex[:8]), F.lit("."), F.spark_partition_id().cast("string"))
        return ranged.withColumn(REGION, name)

    def upsert(self, batch: DataFrame, unique: bool = False) -> int:
        """Upsert cells by key; returns the batch's cells, one per key."""
        if not self.regions():
            return self.load(batch, unique)

        def body(tx: Transaction) -> int:
            least: dict[str, tuple] = {}
            for s in tx.tables[_TABLE].segments:
                label = s.part[0]
                least[label] = min(least.get(label, s.lo), s.lo)
            order = sorted(least, key=least.get)
            rows = batch.select(*KEYS, "value").withColumn(
                REGION, region_of([least[x] for x in order[1:]], order))
            n = tx.upsert(_TABLE, rows, KEYS, unique=unique, fixed=True)
            for s in tx.tables[_TABLE].segments:
                if (size := s.size * PACKED) > 2 * self.region_bytes:
                    old = self.store.load(tx.tables[_TABLE].schema, [s]).drop(REGION)
                    tx.replace(_TABLE, [s], self._split(old, ceil(size / self.region_bytes)),
                               placed=True)
            return n

        return self.store.run(body)

    def scan(self, start: str | None = None, stop: str | None = None,
             family: str | None = None) -> DataFrame:
        """Cells with ``start <= rowkey < stop``, of one family if given."""
        rows = self.store.read(_TABLE, lo=(start or "",), hi=None if stop is None else (stop,))
        if start is not None or stop is not None:
            rows = rows.where(key_range("rowkey", start, stop))
        if family is not None:
            rows = rows.where(F.col("family") == family)
        return rows.drop(REGION)
