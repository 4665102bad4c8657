"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The listed columns of one input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def words(text: bytes | None) -> list[bytes]:
    """``[^\\x20\\x09-\\x0D]+`` of the text, A-Z lowered (bytes.lower and
    bytes.split know ASCII only); none for null."""
    return text.lower().split() if text else []


def merged(spans: list[list[int]]) -> list[list[int]]:
    """The same stretches in order, overlapping ones as one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int
           ) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about ``limit`` bytes of text (a longer text
    is a slice of its own), so that memory follows the bytes, not the rows."""
    for batch in batches:
        start = size = 0
        for i, n in enumerate(pa.compute.binary_length(
                batch.column(column).cast(pa.large_binary())).to_pylist()):
            if size and size + (n or 0) > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch from lists, arrays or Arrow arrays."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type)
         for c, f in zip(columns, schema)], schema=schema)
