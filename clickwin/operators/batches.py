"""Keyed writes in numbered batches, each published on its own.

A long write is cut into batches that are committed one after another: a batch
that fails is left out whole, the ones before it stay, and the error tells how
many rows they wrote.  The number of the last batch is published with its
rows, so the same job started again goes on behind it and a batch that was
already published is not written twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwin.operators.upsert import null_safe_keys
from clickwin.session import scratch_path
from clickwin.sources.snapshots import Store, Table

BATCH = "__batch"


class BatchFailed(RuntimeError):
    """A batch was refused or failed; ``rows`` were written before it."""

    def __init__(self, batch: int, rows: int, cause: str):
        super().__init__(f"batch {batch} failed after {rows} rows were written: {cause}")
        self.batch, self.rows = batch, rows


def progress(store: Store, job: str) -> tuple[int, int]:
    """Number of the last batch that ``job`` published, and its rows so far."""
    return tuple(store.state().values.get(f"batches:{job}", (0, 0)))


def by_key(rows: DataFrame, keys: Sequence[str], size: int) -> Column:
    """Batch numbers from 1, about ``size`` rows each, all rows of a key in the
    same batch; the same rows get the same numbers in every run."""
    count = max(1, -(-rows.count() // size))
    return F.pmod(F.xxhash64(*null_safe_keys(rows, keys)), F.lit(count)).cast("int") + 1


def write_batches(store: Store, table: str, rows: DataFrame, keys: Sequence[str], job: str,
                  batch: Column, order_desc: Sequence[str] | None = None,
                  layout: Table | None = None, require: Column | None = None) -> int:
    """Upsert rows batch by batch in the order of their numbers; returns the
    affected rows of all batches (one per key and batch).

    Within a batch the greatest ``order_desc`` row of a key wins, a later batch
    over an earlier one.  ``require`` is a condition that every row must meet:
    a batch with a row that does not (or where it is unknown) is refused.
    Raises ``BatchFailed``; a new call with the same ``job`` and the same rows
    continues with the batch that failed.
    """
    staged = scratch_path(rows.sparkSession, "batches")
    # the rows are computed once; each batch then reads its own folder
    rows.withColumn(BATCH, batch.cast("int")).hint("rebalance", BATCH).write.partitionBy(
        BATCH).parquet(staged)
    spark = rows.sparkSession
    numbers = sorted(int(n.split("=")[1]) for n, _ in Store(spark, staged).files.names("")
                     if n.startswith(f"{BATCH}="))
    for number in numbers:
        last, done = progress(store, job)
        if number <= last:
            continue
        part = spark.read.schema(rows.schema).parquet(f"{staged}/{BATCH}={number}")
        try:
            if require is not None:
                bad = part.where(~F.coalesce(require, F.lit(False))).limit(1).count()
                if bad:
                    raise ValueError("a row does not meet the condition")

            def body(tx, part=part, number=number, done=done):
                n = done + tx.upsert(table, part, keys, layout, order_desc)
                tx.values[f"batches:{job}"] = (number, n)

            store.run(body)
        except Exception as e:
            raise BatchFailed(number, done, str(e)) from e
    return progress(store, job)[1]
