"""Record <-> map conversions as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def struct_to_map(columns: Sequence[str]) -> Column:
    """Columns -> ``name -> string value`` map, in the given order."""
    return F.map_from_arrays(F.array(*[F.lit(c) for c in columns]),
                             F.array(*[F.col(c).cast("string") for c in columns]))


def struct_to_array(columns: Sequence[str]) -> Column:
    """Field values in declared order, as strings."""
    return F.array(*[F.col(c).cast("string") for c in columns])


def map_to_struct(m, schema: StructType) -> Column:
    """Map -> typed struct; field names matched case-sensitively.

    Values are cast to the field types with ``try_cast`` semantics (a value
    that does not convert gives null).
    """
    mc = _c(m)
    return F.struct(*[mc.getItem(f.name).try_cast(f.dataType).alias(f.name)
                      for f in schema.fields])


def map_to_struct_ci(m, schema: StructType) -> Column:
    """As ``map_to_struct`` but field names matched ignoring case."""
    upper = F.transform_keys(_c(m), lambda k, v: F.upper(k))
    return F.struct(*[upper.getItem(f.name.upper()).try_cast(f.dataType).alias(f.name)
                      for f in schema.fields])


def map_as_text(m) -> Column:
    """Map -> ``k=v;k=v`` with keys sorted (stable text for comparisons)."""
    entries = F.array_sort(F.map_entries(_c(m)))
    return F.array_join(F.transform(entries, lambda e: F.concat(
        e["key"], F.lit("="), F.coalesce(e["value"], F.lit("\\N")))), ";")
