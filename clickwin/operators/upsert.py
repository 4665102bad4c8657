"""Keyed upsert, partial-column upsert, ragged records, delete and update.

A keyed table behaves like the SQL layer the page-view jobs write to:
writing a row whose key exists replaces it ("upsert"), other rows stay.
Without a merge-capable table format this is a null-safe full outer join
of the stored rows with the batch, and a dynamic partition overwrite of
only the partitions the batch touches.

Scale notes.
* Keys are unique on both sides of the join (the batch is reduced to one
  row per key first), so the join has no hot keys whatever the input skew.
* The dedup uses ``row_number() = 1``, which Spark plans with a partial
  ``WindowGroupLimit`` before the shuffle: a key repeated in a third of the
  batch ships one row per map task.
* Only touched partitions are read and rewritten: the stored side is
  semi-joined with the batch's partition values (a tiny, per-window set),
  which also enables dynamic partition pruning of the scan.
* The merged rows are written to a staging folder under the shared
  checkpoint directory first, so the overwrite never reads the files it
  replaces and a lost executor only reruns its task.

Partitions are matched null-safe and by their folders' names on disk, so null
and odd partition values are values like any other.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from clickwin.session import materialize, scratch_path

_NEW = "__new_row"


def dedupe_latest(batch: DataFrame, keys: Sequence[str],
                  order_desc: Sequence[str] | None = None) -> DataFrame:
    """One row per key; the row with the greatest ``order_desc`` wins.

    Without an order the winner is the greatest row by all non-key columns,
    which is deterministic (the reference left it to arrival order).
    """
    order = list(order_desc) if order_desc else [c for c in batch.columns if c not in keys]
    if not order:
        return batch.dropDuplicates(list(keys))
    # Partition by the same expressions the null-safe join shuffles on, so
    # the join reuses this partitioning instead of shuffling the batch again.
    w = Window.partitionBy(*null_safe_keys(batch, keys)).orderBy(
        *[F.col(c).desc_nulls_last() for c in order])
    return batch.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


_DEFAULTS = {"string": "", "boolean": False}


def null_safe_keys(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """``(coalesce(k, default), isnull(k))`` per key: the hash keys Spark uses
    for a ``<=>`` equi-join.  Partitioning by them groups exactly like
    partitioning by ``k`` (null forms its own group)."""
    types = dict(df.dtypes)
    out: list[Column] = []
    for k in keys:
        t = types[k]
        if t in _DEFAULTS:
            d = F.lit(_DEFAULTS[t])
        elif t in ("tinyint", "smallint", "int", "bigint", "float", "double") or \
                t.startswith("decimal"):
            d = F.lit(0).cast(t)
        else:
            # dates, timestamps, ...: compare their text form, still null-safe
            out += [F.coalesce(F.col(k).cast("string"), F.lit("")), F.isnull(F.col(k))]
            continue
        out += [F.coalesce(F.col(k), d), F.isnull(F.col(k))]
    return out


def _with_join_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    exprs = null_safe_keys(df, keys)
    names = [f"__k{i}" for i in range(len(exprs))]
    return df.select("*", *[e.alias(n) for e, n in zip(exprs, names)]), names


def merge_upsert(old: DataFrame, new: DataFrame, keys: Sequence[str],
                 columns: Sequence[str] | None = None, dedupe: bool = False,
                 order_desc: Sequence[str] | None = None, one_pass: bool = False) -> DataFrame:
    """Rows of ``old`` with ``new`` upserted by (null-safe) ``keys``.

    ``columns`` is the batch's column list (defaults to all of ``new``'s
    columns).  Listed columns take the batch value -- a null in the batch
    overwrites; unlisted columns keep the stored value, and are null for new
    keys (partial-column upsert).  ``new`` must hold one row per key unless
    ``dedupe`` is set (then the greatest ``order_desc`` row of a key wins).

    The join is an equi-join on materialised ``(coalesce(k, default),
    isnull(k))`` columns -- the same null-safe semantics as ``<=>`` -- and the
    dedup window is partitioned on those very columns.  A full-row upsert is
    an anti-join and a union, which reads ``new`` twice but never shuffles
    ``old`` for a small, stored batch; ``one_pass`` plans one full outer join
    instead, which evaluates both sides once (for a batch that is costly to
    compute).
    """
    cols = list(columns) if columns is not None else list(new.columns)
    missing = [k for k in keys if k not in cols]
    if missing:
        raise ValueError(f"batch lacks key columns {missing}")
    n, kn = _with_join_keys(new.select(*cols), keys)
    if dedupe:
        order = list(order_desc) if order_desc else [c for c in cols if c not in keys]
        w = Window.partitionBy(*kn).orderBy(*[F.col(c).desc_nulls_last() for c in order])
        n = n.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    o, ko = _with_join_keys(old, keys)
    if set(cols) == set(old.columns) and not one_pass:
        # Full-row upsert: stored rows whose key is not in the batch, plus the
        # batch.  The anti-join needs only the batch's keys, so a small batch
        # is broadcast by AQE and the stored side is never shuffled.
        kept = o.join(n.select(*kn), kn, "left_anti").select(*old.columns)
        return kept.unionByName(n.select(*old.columns))
    o = o.alias("o")
    n = n.withColumn(_NEW, F.lit(True)).alias("n")
    cond = None
    for k in kn:
        c = F.col(f"o.{k}") == F.col(f"n.{k}")
        cond = c if cond is None else cond & c
    joined = o.join(n, cond, "full_outer")
    present = F.col(f"n.{_NEW}").isNotNull()
    out = []
    for c in old.columns:
        if c in cols:
            out.append(F.when(present, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            # stored value; null for a new key (no stored row)
            out.append(F.col(f"o.{c}").alias(c))
    extra = [c for c in cols if c not in old.columns]
    out += [F.col(f"n.{c}").alias(c) for c in extra]
    return joined.select(*out)


def positional(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Attach an explicit, case-exact column list by position."""
    if len(columns) != len(df.columns):
        raise ValueError(f"{len(columns)} names for {len(df.columns)} columns")
    return df.toDF(*columns)


def upper_columns(df: DataFrame) -> DataFrame:
    """Upper-case every column name (the SQL layer's rule for DataFrame writes)."""
    return df.toDF(*[c.upper() for c in df.columns])


def widest_map_keys(maps: DataFrame, map_col: str, order: Sequence[str]) -> list[str]:
    """Keys of the widest map (the first in ``order`` on ties).

    Only that one key list reaches the driver; its size is bounded by the
    record width, not by the number of records.
    """
    row = (maps.orderBy(F.size(map_col).desc(), *[F.col(c) for c in order])
           .select(F.map_keys(map_col).alias("k")).first())
    return list(row["k"]) if row is not None else []


def all_map_keys(maps: DataFrame, map_col: str) -> list[str]:
    """Every key of any map, sorted (one short row per key reaches the driver)."""
    rows = maps.select(F.explode(F.map_keys(map_col)).alias("k")).distinct().collect()
    return sorted(r["k"] for r in rows)


def dropped_entries(maps: DataFrame, map_col: str, keys: Sequence[str],
                    out: str = "DROPPED") -> DataFrame:
    """One row: the entries that a column list of ``keys`` leaves out."""
    other = F.size(F.array_except(F.map_keys(map_col), F.array(*[F.lit(k) for k in keys])))
    return maps.agg(F.coalesce(F.sum(other), F.lit(0)).cast("bigint").alias(out))


def ragged_maps_to_rows(maps: DataFrame, map_col: str, order: Sequence[str],
                        keys: Sequence[str] | None = None, union: bool = False) -> DataFrame:
    """Records as maps with differing key sets -> rows.

    Columns are the keys of the widest map (a key outside that list is
    dropped; ``dropped_entries`` counts them), or with ``union`` the keys of
    any map.  A missing key gives null.  Finding the keys runs a job.
    """
    cols = (list(keys) if keys is not None else all_map_keys(maps, map_col) if union
            else widest_map_keys(maps, map_col, order))
    return maps.select(*[F.col(map_col).getItem(k).alias(k) for k in cols])


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Table without the rows where ``cond`` is true (unknown keeps the row)."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def update_where(df: DataFrame, assignments: Mapping[str, Column], cond: Column) -> DataFrame:
    """``UPDATE t SET c = v WHERE cond`` as a projection."""
    hit = F.coalesce(cond, F.lit(False))
    return df.select(*[F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c)
                       if c in assignments else F.col(c) for c in df.columns])


def affected(df: DataFrame, cond: Column, out: str = "AFFECTED") -> DataFrame:
    """Rows a DELETE / UPDATE with ``cond`` touches."""
    return df.agg(F.count_if(F.coalesce(cond, F.lit(False))).alias(out))


# -- storage ----------------------------------------------------------------

def path_exists(spark: SparkSession, path: str, hidden: bool = False) -> bool:
    """True when ``path`` holds a table with at least one data file (with
    ``hidden``: when it is there at all).

    A folder left by writing an empty result has no schema to read, so it
    counts as absent.  The listing stops at the first data file.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if hidden or not fs.exists(p):
        return fs.exists(p)
    it = fs.listFiles(p, True)
    while it.hasNext():
        st = it.next()
        rel = str(st.getPath().toUri().getPath())[len(str(p.toUri().getPath())):]
        if not any(part.startswith(("_", ".")) for part in rel.split("/") if part):
            return True
    return False


def table_exists(spark: SparkSession, path: str) -> bool:
    """``path_exists``; reads only (an overwrite that was cut off is finished
    by writers, see ``recover``)."""
    return path_exists(spark, path)


def read_table(spark: SparkSession, path: str, partition_by: Sequence[str] = (),
               fmt: str = "parquet") -> DataFrame:
    """Read a stored table; partition columns come back as strings."""
    df = spark.read.format(fmt).load(path)
    if partition_by:
        from pyspark.sql.types import StringType, StructField, StructType
        fields = [StructField(f.name, StringType(), True) if f.name in partition_by else f
                  for f in df.schema.fields]
        df = spark.read.format(fmt).schema(StructType(fields)).load(path)
    return df


def read_partitions(spark: SparkSession, path: str, part: str, dirs: Sequence[str],
                    fmt: str = "parquet") -> DataFrame:
    """Read some partition folders of a table (listing only those folders);
    the partition column comes back as a string."""
    from pyspark.sql.types import StringType, StructField, StructType
    probe = spark.read.format(fmt).option("basePath", path).load(list(dirs))
    fields = [StructField(f.name, StringType(), True) if f.name == part else f
              for f in probe.schema.fields]
    return spark.read.format(fmt).schema(StructType(fields)).option("basePath", path).load(
        list(dirs))


def write_upsert(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                 partition_by: Sequence[str] = (), order_desc: Sequence[str] | None = None,
                 columns: Sequence[str] | None = None, fmt: str = "parquet",
                 unique: bool = False, partition_values: Sequence[str] | None = None
                 ) -> int:
    """Upsert ``batch`` into the table at ``path`` (created when absent);
    returns the affected rows (the batch's rows, one per key).

    ``unique=True`` skips the dedup when the batch is one row per key by
    construction (a grouped aggregate keyed by the table key).
    ``partition_values`` (single partition column) names the partitions the
    batch can touch; when none of them exists yet there is nothing to merge
    and the batch is written straight into new partitions.  Without it, a key
    that is stored in another partition moves: unless the partition columns
    are keys, the others are searched for the batch's keys.

    This layout (one folder per partition value, readable as plain Parquet)
    is for one writer at a time; ``sources.snapshots`` keeps readers and
    several writers apart.
    """
    part = list(partition_by)
    _finish_dead(spark, path)
    fresh = not table_exists(spark, path)
    touched_dirs = None
    if not fresh and partition_values is not None and len(part) == 1:
        touched_dirs = [d for d in (f"{path.rstrip('/')}/{part[0]}={v}"
                                    for v in partition_values) if path_exists(spark, d)]
        fresh = not touched_dirs
    if fresh:
        if not unique:
            batch = dedupe_latest(batch, keys, order_desc)
        seen = Observation()
        _write(batch.observe(seen, F.count(F.lit(1)).alias("n")), path, part, fmt, "overwrite")
        return int(seen.get["n"])
    if touched_dirs:
        # Read only the touched partition folders: plain Parquet would list
        # every partition of the table first, however many windows it holds.
        old = read_partitions(spark, path, part[0], touched_dirs, fmt)
    else:
        old = read_table(spark, path, part, fmt)
    order = old.columns
    # evaluated once, read for the touched partitions, the keys and the rows
    reduced = scratch_path(spark, "upsert-batch")
    (batch if unique else dedupe_latest(batch, keys, order_desc)).write.parquet(reduced)
    batch = read_table(spark, reduced, part)
    affected_rows = batch.count()           # from the file footers
    read = None
    if part and not touched_dirs:
        touched = batch.select(*part)
        if not set(part) <= set(keys):      # partitions that hold the keys now
            holding = _matching(old, batch.select(*keys), keys).select(*part)
            touched = touched.unionByName(holding)
            # such a partition may be left without rows
            read = _folders(spark, path, _matching(
                old.select(*part, _folder()), holding.distinct(), part))
        old = _matching(old, touched.distinct(), part)
    merged = merge_upsert(old, batch, keys, columns)
    merged = merged.select(*order, *[c for c in merged.columns if c not in order])
    _replace(spark, path, merged, part, fmt, read)
    _delete_quietly(spark, reduced)
    return affected_rows


def _matching(rows: DataFrame, wanted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose columns equal (null-safe) a row of ``wanted``."""
    left, names = _with_join_keys(rows, columns)
    right, _ = _with_join_keys(wanted, columns)
    return left.join(right.select(*names), names, "left_semi").select(*rows.columns)


def _folder() -> Column:
    """The folder of a row's file."""
    return F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("__folder")


def _folders(spark: SparkSession, path: str, rows: DataFrame) -> list[str]:
    """Partition folders of the rows' files, as they are named on disk below
    ``path`` (one row per partition reaches the driver)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()
    names = []
    for r in rows.select("__folder").distinct().collect():
        full = jvm.java.net.URI(r["__folder"]).getPath()
        names.append(full[full.index(root) + len(root):].strip("/"))
    return names


def _replace(spark: SparkSession, path: str, merged: DataFrame, part: Sequence[str], fmt: str,
             read: Sequence[str] | None = None) -> None:
    """Overwrite the table's touched partitions (all of it, unpartitioned)
    with rows that were derived from it.  Of the partition folders ``read``,
    those for which no row is left go."""
    staging = scratch_path(spark, "upsert-staging")
    _write(merged, staging, part, fmt, "overwrite")
    emptied = [d for d in read or () if not path_exists(spark, f"{staging}/{d}")]
    # from here on the merged rows are safe: a cut-off overwrite is repeated
    # from the staging copy by the next writer
    note = spark.createDataFrame([(staging, ",".join(part), fmt, ",".join(merged.columns),
                                   emptied)], _NOTE)
    note.coalesce(1).write.mode("errorifexists").parquet(_pending(path))
    _finish(spark, path, staging, part, fmt, merged.columns, emptied)


def rewrite_where(spark: SparkSession, path: str, cond: Column,
                  assignments: Mapping[str, Column] | None = None,
                  partition_by: Sequence[str] = (), fmt: str = "parquet") -> int:
    """DELETE (or with ``assignments`` UPDATE) the stored rows where ``cond``
    is true; returns how many, once they are gone (a failure raises).  Only
    partitions that hold such rows are rewritten; assignments may not move a
    row to another partition."""
    _finish_dead(spark, path)
    if not table_exists(spark, path):
        return 0
    part = list(partition_by)
    stored = read_table(spark, path, part, fmt)
    hit = F.coalesce(cond, F.lit(False))
    # one row per partition that holds such rows
    found = stored.select("*", _folder()).where(hit).groupBy("__folder").count()
    found = materialize(found, "rewrite-folders")
    number = found.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    if not number:
        return 0
    if part:
        rows = _matching(stored, stored.where(hit).select(*part).distinct(), part)
    else:
        rows = stored
    left = update_where(rows, assignments, cond) if assignments else delete_where(rows, cond)
    _replace(spark, path, left, part, fmt, _folders(spark, path, found) if part else None)
    return int(number)


_NOTE = "staging string, part string, fmt string, columns string, emptied array<string>"
LEASE_SECONDS = 900         # a note that old is a dead writer's


class WriteInProgress(RuntimeError):
    """Another writer is replacing this table's rows (or died doing so a short
    while ago)."""


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}.pending"


def _finish(spark, path, staging, part, fmt, columns, emptied) -> None:
    if path_exists(spark, staging):         # else no row is left at all
        _write(read_table(spark, staging, part, fmt).select(*columns), path, part, fmt,
               "overwrite")
    elif not part:
        _delete(spark, path)
    for folder in emptied:
        _delete(spark, f"{path.rstrip('/')}/{folder}")
    # the overwrite has committed: the note goes first, then the staging copy
    _delete(spark, _pending(path))
    _delete_quietly(spark, staging)


def _finish_dead(spark: SparkSession, path: str) -> None:
    """What a writer does about another's unfinished overwrite: repeat it if
    the other is dead (its note is older than the lease), else stop."""
    note = f"{_pending(path)}/_SUCCESS"
    if not path_exists(spark, note, hidden=True):
        return
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(note)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if time.time() - fs.getFileStatus(p).getModificationTime() / 1000 < LEASE_SECONDS:
        raise WriteInProgress(f"{path} is being written; if that writer is dead, call recover()")
    recover(spark, path)


def recover(spark: SparkSession, path: str) -> bool:
    """Repeat an overwrite of the table at ``path`` that did not finish (the
    driver or the job died between the staging copy and the commit).  Only
    writers call it, never readers."""
    if not path_exists(spark, f"{_pending(path)}/_SUCCESS", hidden=True):
        return False
    note = spark.read.schema(_NOTE).parquet(_pending(path)).first()
    # a staging folder that is gone means an overwrite that finished, but for the note
    if not path_exists(spark, note["staging"], hidden=True):
        _delete(spark, _pending(path))
        return False
    _finish(spark, path, note["staging"], [c for c in note["part"].split(",") if c],
            note["fmt"], note["columns"].split(","), note["emptied"] or [])
    return True


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.delete(p, True) and fs.exists(p):
        raise OSError(f"could not delete {path}")


def _delete_quietly(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 -- a leftover staging folder is harmless
        pass


def upsert_sql(spark: SparkSession, path: str, sql: str, args, keys: Sequence[str],
               partition_by: Sequence[str] = ()) -> int:
    """Upsert the rows a SQL statement with bound values produces, e.g.
    ``SELECT ? AS ENDTIME, ? AS STARTTIME`` with ``args=[end, start]``.
    Values are bound, never spliced into the text."""
    return write_upsert(spark, path, spark.sql(sql, args=args), keys, partition_by)


def _write(df: DataFrame, path: str, part: Sequence[str], fmt: str, mode: str) -> None:
    if part:
        # Cluster rows by partition value before a partitioned write: without
        # it every task writes a file into every partition it holds rows for
        # (tasks x partitions small files).  REBALANCE lets AQE coalesce small
        # partitions and split a skewed one, so a hot window or day is still
        # written by several tasks.
        df = df.hint("rebalance", *part)
    w = df.write.format(fmt).mode(mode)
    if part:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*part)
    w.save(path)
