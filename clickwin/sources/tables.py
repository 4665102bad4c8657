"""Scans of named tables and of SQL subqueries.

A "table" is any path Spark can read (Parquet by default).  Filters and
column lists given here reach the scan as ``PushedFilters`` / ``ReadSchema``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet",
               options: Mapping[str, str] | None = None, schema=None) -> DataFrame:
    """Load a named table; schema discovered from the source unless given."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def scan_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Only the listed columns (column pruning reaches the scan)."""
    return df.select(*list(columns))


def scan_sql_subquery(spark: SparkSession, sql: str, views: Mapping[str, DataFrame],
                      args: Mapping | list | None = None) -> DataFrame:
    """Result of a SQL subquery over registered views.

    Values are bound with ``args`` (named ``:x`` or positional ``?``) rather
    than spliced into the text.
    """
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=args) if args is not None else spark.sql(sql)


def scan_jdbc(spark: SparkSession, url: str, query: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int = 1,
              predicates: list[str] | None = None, properties: Mapping[str, str] | None = None
              ) -> DataFrame:
    """A SQL subquery read over JDBC, split into parallel partitions.

    A JDBC read without bounds or predicates is one task; pass either a
    numeric ``partition_column`` with bounds, or one predicate per slice
    (for example one per hour of ``TIME``).
    """
    props = dict(properties or {})
    table = f"({query}) q"
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)
    if partition_column is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)


def scan_as_maps(df: DataFrame, columns: Iterable[str], out: str = "m") -> DataFrame:
    """Each row as one ``column -> value`` map (values as strings)."""
    cols = list(columns)
    return df.select(F.map_from_arrays(F.array(*[F.lit(c) for c in cols]),
                                       F.array(*[F.col(c).cast("string") for c in cols])
                                       ).alias(out))


def hour_predicates(column: str, keys: Iterable[str]) -> list[str]:
    """One ``[k, next)`` predicate per consecutive pair of keys (JDBC slices)."""
    ks = list(keys)
    return [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(ks, ks[1:])]

