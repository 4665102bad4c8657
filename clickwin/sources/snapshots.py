"""Keyed tables whose writes are published as a whole.

A store is a folder of Parquet data folders that are never changed once
written, and numbered manifests.  A manifest names the data folders
("segments") of every table in the store; the one with the highest number is
the store's state.

* **Readers** take the newest manifest and read its folders.  They write
  nothing.  A write that goes on meanwhile adds folders which no manifest
  names yet, so a reader sees the state before it or after it.
* **Writers** write new folders with ordinary Spark jobs and then create the
  next manifest, which fails if it exists.  Whatever one transaction did to
  several tables (result rows and window markers) appears at once.  A writer
  that dies before that step has changed nothing.
* **Two writers**: the one that comes second finds its number taken.  If the
  other changed none of the rows it relied on, its changes are put on top of
  the new state (both are kept), else ``ConcurrentWrite`` is raised.
* Folders no longer named are deleted once ``grace`` seconds have passed, by
  later commits; what dead writers left is found by ``vacuum``.

A segment holds one partition's rows (partition columns are kept in the files,
so null and odd values are values like any other) and, for ``zone`` columns,
the least and greatest values.  An upsert reads and rewrites only segments
whose partition and zone meet the batch; others are left in place, and a batch
that meets none is published as written, without a second copy.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from clickwin.operators import upsert as up

GRACE_SECONDS = 3600        # readers may hold a state that long after it was replaced
MAX_SEGMENTS = 16           # of a partition; more are merged into one
KEEP_MANIFESTS = 50
TASK_BYTES = 16 << 20       # of files that one task merges (sorted rows take about 20 times that)
PART = "__part"
_NEW = "__new"


class ConcurrentWrite(RuntimeError):
    """Another writer changed rows that this write relied on."""


@dataclass(frozen=True)
class Segment:
    """A data folder: its partition (values as text, null as None), the least
    and greatest zone values (None: unknown, meets everything), its bytes."""
    dir: str
    part: tuple = ()
    lo: tuple | None = None
    hi: tuple | None = None
    size: int = 0

    def meets(self, lo: tuple | None, hi: tuple | None) -> bool:
        return None in (self.lo, self.hi, lo, hi) or (self.lo <= hi and lo <= self.hi)


EVERYWHERE = Segment("")


@dataclass(frozen=True)
class Table:
    """A table in one state: its columns, layout and segments.

    Zone bounds of a write are those of all its rows, or with ``each`` those of
    every partition (found by reading the zone columns back); ``sort`` orders
    the rows inside files.
    """
    schema: StructType
    partition_by: tuple = ()
    zone: tuple = ()
    sort: tuple = ()
    each: bool = False
    segments: tuple = ()


@dataclass
class State:
    """What one manifest says."""
    version: int = 0
    tables: dict = field(default_factory=dict)
    values: dict = field(default_factory=dict)      # small facts published with the tables
    dropped: dict = field(default_factory=dict)     # folder -> second it was dropped

    def to_json(self) -> str:
        tables = {n: {"schema": t.schema.jsonValue(), "partition_by": t.partition_by,
                      "zone": t.zone, "sort": t.sort, "each": t.each, "segments": [[s.dir, s.part, s.lo, s.hi, s.size]
                                                   for s in t.segments]}
                  for n, t in self.tables.items()}
        return json.dumps({"version": self.version, "tables": tables, "values": self.values,
                           "dropped": self.dropped})

    @classmethod
    def from_json(cls, text: str) -> State:
        doc = json.loads(text)

        def tup(x):
            return None if x is None else tuple(x)

        tables = {n: Table(StructType.fromJson(t["schema"]), tuple(t["partition_by"]),
                           tuple(t["zone"]), tuple(t["sort"]), t["each"], tuple(Segment(d, tup(p), tup(lo), tup(hi), size)
                                                   for d, p, lo, hi, size in t["segments"]))
                  for n, t in doc["tables"].items()}
        return cls(doc["version"], tables, doc["values"], doc["dropped"])


class Files:
    """The few file-system calls a store needs, through Hadoop's client (so
    they reach whatever the session's paths reach)."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[tuple[str, int]]:
        """``(name, modification second)`` of a folder's entries."""
        p = self.path(folder)
        if not self.fs.exists(p):
            return []
        return [(s.getPath().getName(), s.getModificationTime() // 1000)
                for s in self.fs.listStatus(p)]

    def size(self, folder: str) -> int:
        return self.fs.getContentSummary(self.path(folder)).getLength()

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file whole under a name that must be new; False if taken."""
        draft = f"{name.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        out = self.fs.create(self.path(draft), True)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self.path("").toUri() if "://" in self.root else self.fs.getUri(), self.conf)
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            # without an option the target must not exist (unlike FileSystem.rename)
            context.rename(self.path(draft), self.path(name), self.gateway.new_array(kind, 0))
            return True
        except Exception as e:
            self.delete(draft)
            if "FileAlreadyExists" in str(e):
                return False
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _manifest(version: int) -> str:
    return f"_manifests/{version:012d}.json"


def _label(values: tuple) -> str:
    """A partition's folder label; ``_values`` is its inverse."""
    return "-".join("n" if v is None else "v" + v.encode().hex().upper() for v in values) or "all"


def _values(label: str) -> tuple:
    if label == "all":
        return ()
    return tuple(None if x == "n" else bytes.fromhex(x[1:]).decode() for x in label.split("-"))


def _label_column(columns: Sequence[str]) -> Column:
    if not columns:
        return F.lit("all")
    return F.concat_ws("-", *[F.coalesce(F.concat(F.lit("v"), F.hex(F.encode(
        F.col(c).cast("string"), "UTF-8"))), F.lit("n")) for c in columns])


class Store:
    """A folder of tables; see the module's docstring."""

    def __init__(self, spark: SparkSession, root: str, grace: float = GRACE_SECONDS):
        self.spark, self.root, self.grace = spark, root.rstrip("/"), grace
        self.files = Files(spark, root)

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n, _ in self.files.names("_manifests")
                      if n.endswith(".json") and not n.startswith("."))

    def state(self) -> State:
        """The newest state (version 0, without tables, before any write)."""
        versions = self.versions()
        return State.from_json(self.files.read(_manifest(versions[-1]))) if versions else State()

    def table(self, name: str) -> Table | None:
        return self.state().tables.get(name)

    def read(self, name: str, parts: Sequence[tuple] | None = None, lo: tuple | None = None,
             hi: tuple | None = None) -> DataFrame:
        """The table's rows, of the listed partitions only and of segments that
        meet ``[lo, hi]`` of the zone columns (rows are not filtered: add the
        exact condition, which Spark pushes to the files)."""
        table = self.table(name)
        if table is None:
            raise FileNotFoundError(f"no table {name!r} was written yet under {self.root}")
        return self.load(table.schema, [s for s in table.segments if s.meets(lo, hi)
                                        and (parts is None or s.part in parts)])

    def load(self, schema: StructType, segments: Sequence[Segment]) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], schema)
        # the columns are known: no file is opened to find them
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{s.dir}" for s in segments])

    def greatest(self, name: str, column: str) -> str | None:
        """Greatest value of the first zone column, from the manifest alone."""
        table = self.table(name)
        if table is None or not table.segments:
            return None
        if table.zone[:1] != (column,) or any(s.hi is None for s in table.segments):
            return self.read(name).agg(F.max(column)).first()[0]
        return max(s.hi[0] for s in table.segments)

    def begin(self) -> Transaction:
        return Transaction(self)

    def run(self, body: Callable[[Transaction], object], attempts: int = 3):
        """``body`` in a transaction, repeated on the new state if another
        writer changed rows that it relied on."""
        for left in range(attempts - 1, -1, -1):
            tx = self.begin()
            try:
                result = body(tx)
                tx.commit()
                return result
            except ConcurrentWrite:
                tx.abandon()
                if not left:
                    raise

    def vacuum(self) -> int:
        """Delete data folders that no kept manifest names and that are older
        than the grace period (left by dead writers); returns how many."""
        named = set()
        for version in self.versions():
            named |= {s.dir.split("/")[1] for t in State.from_json(
                self.files.read(_manifest(version))).tables.values() for s in t.segments}
        old = [n for n, at in self.files.names("data")
               if n not in named and at < time.time() - self.grace]
        for name in old:
            self.files.delete(f"data/{name}")
        return len(old)


class Transaction:
    """Changes to a store's tables that are published by ``commit``."""

    def __init__(self, store: Store):
        self.store, self.spark = store, store.spark
        self.base = store.state()
        self.tables = dict(self.base.tables)
        self.values: dict = {}
        self._out: dict[str, set] = {}              # table -> folders replaced
        self._met: dict[str, list] = {}             # table -> segments' places relied on
        self._mine: list[str] = []                  # folders written
        self._keep: set[str] = set()
        self._over: list[str] = []                  # folders dropped before the grace period

    # -- writing ------------------------------------------------------------

    def _write(self, table: Table, rows: DataFrame, placed: bool = False
               ) -> tuple[list[Segment], int]:
        """Write rows in the table's layout, one folder a partition; the
        segments and the number of rows.  ``placed`` says that each task's rows
        belong together already."""
        zone = table.zone
        name = f"data/{uuid.uuid4().hex[:16]}"
        self._mine.append(name)
        seen = Observation()
        facts = [F.count(F.lit(1)).alias("n")]
        if not table.each:
            facts += _bounds(zone)
        out = rows if PART in rows.columns else rows.withColumn(
            PART, _label_column(table.partition_by))
        if not placed:
            # rows of a partition go together (split where large), not a file per task
            out = out.hint("rebalance", PART)
        # counted by the tasks that write: one that is run again is not counted twice
        out = out.observe(seen, *facts)
        if table.sort:
            out = out.sortWithinPartitions(PART, *table.sort)
        out.write.partitionBy(PART).parquet(f"{self.store.root}/{name}")
        dirs = [d for d, _ in self.store.files.names(name) if d.startswith(f"{PART}=")]
        if not dirs:                # no rows; Spark may have dropped the counting with them
            return [], 0
        got = seen.get
        if table.each and zone:
            stored = self.spark.read.schema(StructType(
                [f for f in rows.schema.fields if f.name != PART])).parquet(
                *[f"{self.store.root}/{name}/{d}" for d in dirs])
            found = folder_bounds(stored, zone).collect()       # a row a partition
            known = {r["folder"]: _zone(r, zone) for r in found}
        else:
            known = dict.fromkeys([f"{name}/{d}" for d in dirs], _zone(got, zone))
        return [Segment(f"{name}/{d}", _values(d.split("=", 1)[1]), *known[f"{name}/{d}"],
                        self.store.files.size(f"{name}/{d}")) for d in dirs], got["n"]

    def _change(self, name: str, table: Table, gone: Sequence[Segment],
                new: Sequence[Segment], met: Sequence[Segment] | None = None) -> None:
        out = {s.dir for s in gone}
        self.tables[name] = replace(table, segments=tuple(
            s for s in table.segments if s.dir not in out) + tuple(new))
        self._out.setdefault(name, set()).update(out)
        self._met.setdefault(name, []).extend(new if met is None else met)

    def _table(self, name: str, rows: DataFrame, layout: Table | None) -> Table:
        """The table as it is, with the batch's further columns, or a new one."""
        table = self.tables.get(name)
        if table is None:
            return replace(layout or Table(StructType()), schema=StructType(
                [StructField(f.name, f.dataType) for f in rows.schema.fields]))
        more = [StructField(f.name, f.dataType) for f in rows.schema.fields
                if f.name not in table.schema.names]
        return replace(table, schema=StructType(table.schema.fields + more)) if more else table

    def append(self, name: str, rows: DataFrame, layout: Table | None = None,
               placed: bool = False) -> int:
        """Add rows (without looking for their keys); returns how many.
        ``layout`` is that of a new table."""
        table = self._table(name, rows, layout)
        new, n = self._write(table, rows, placed)
        self._change(name, table, [], new, met=[])
        self._merge_small(name)
        return n

    def upsert(self, name: str, batch: DataFrame, keys: Sequence[str],
               layout: Table | None = None, order_desc: Sequence[str] | None = None,
               columns: Sequence[str] | None = None, unique: bool = False, fixed: bool = False
               ) -> int:
        """Upsert a batch by (null-safe) keys; returns its rows, one per key.

        ``columns`` lists the batch's columns (others keep their stored
        values, null for a new key).  ``unique`` says that the batch has one
        row per key.  A key that is stored in another partition moves: the
        others are searched for it, unless the partition columns are keys or
        ``fixed`` says that a key never changes partition.
        """
        batch = batch.select(*columns) if columns is not None else batch
        table = self._table(name, batch, layout)
        absent = [c for c in (*table.partition_by, *keys) if c not in batch.columns]
        if absent:
            raise ValueError(f"batch lacks partition or key columns {absent}")
        new, n = self._write(table, batch if unique else up.dedupe_latest(batch, keys, order_desc))
        old = [s for s in table.segments
               if any(s.part == b.part and s.meets(b.lo, b.hi) for b in new)]
        met = list(new)
        searched = bool(table.partition_by) and not fixed and not set(table.partition_by) <= set(keys)
        if searched and new:
            # zones say where the keys can be only if they are made of them
            by_zone = bool(table.zone) and set(table.zone) <= set(keys)
            rest = [s for s in table.segments if s not in old
                    and (not by_zone or any(s.meets(b.lo, b.hi) for b in new))]
            old += self._holding(table, rest, self.store.load(batch.schema, new), keys)
            met.append(EVERYWHERE)              # any change may bring one of the keys
        if not old:
            self._change(name, table, [], new, met)
            self._merge_small(name)
            return n
        parts = {s.part for s in old}
        again = new if searched else [b for b in new if b.part in parts]
        stored, fresh = self.store.load(table.schema, old), self.store.load(batch.schema, again)
        whole = not searched and set(batch.columns) == set(table.schema.names)
        if whole:
            merged = merged_in_ranges(stored, fresh, table.partition_by, keys,
                                      math.ceil(sum(s.size for s in (*old, *again)) / TASK_BYTES))
        else:
            merged = up.merge_upsert(stored, fresh, keys).select(*table.schema.names)
        out, _ = self._write(table, merged, placed=whole)
        self._change(name, table, old, [b for b in new if b not in again] + out, met)
        self._merge_small(name)
        return n

    def _holding(self, table: Table, segments: Sequence[Segment], batch: DataFrame,
                 keys: Sequence[str]) -> list[Segment]:
        """The segments that hold a key of the batch (one name per segment
        reaches the driver)."""
        if not segments:
            return []
        stored, names = up._with_join_keys(
            self.store.load(table.schema, segments).select(*keys, _folder()), keys)
        wanted, _ = up._with_join_keys(batch.select(*keys), keys)
        hit = {r[0] for r in stored.join(wanted.select(*names), names, "left_semi")
               .select("folder").distinct().collect()}
        return [s for s in segments if s.dir in hit]

    def rewrite(self, name: str, cond: Column, assignments: Mapping[str, Column] | None = None
                ) -> int:
        """DELETE (or with ``assignments`` UPDATE) the rows where ``cond`` is
        true; returns how many.  Only segments that hold such rows are read
        again and replaced; an update may move rows to other partitions."""
        table = self.tables.get(name)
        if table is None:
            return 0
        found = (self.store.load(table.schema, table.segments).where(cond)
                 .groupBy(_folder()).count().collect())       # one row per segment hit
        hit = {r["folder"]: r["count"] for r in found}
        old = [s for s in table.segments if s.dir in hit]
        if not old:
            self._change(name, table, [], [], met=[EVERYWHERE])
            return 0
        rows = self.store.load(table.schema, old)
        left = up.update_where(rows, assignments, cond) if assignments else up.delete_where(rows, cond)
        new, _ = self._write(table, left)
        self._change(name, table, old, new, met=[EVERYWHERE])
        return sum(hit.values())

    def replace(self, name: str, gone: Sequence[Segment], rows: DataFrame, placed: bool = False
                ) -> None:
        """Put rows in the place of segments."""
        table = self.tables[name]
        new, _ = self._write(table, rows, placed)
        self._change(name, table, gone, new)

    def _merge_small(self, name: str) -> None:
        """Partitions of many segments become one segment each."""
        table = self.tables[name]
        by_part: dict[tuple, list] = {}
        for s in table.segments:
            by_part.setdefault(s.part, []).append(s)
        for group in by_part.values():
            if len(group) > MAX_SEGMENTS:
                self.replace(name, group, self.store.load(table.schema, group))

    # -- publishing ---------------------------------------------------------

    def commit(self) -> int:
        """Publish all changes at once; returns the version.  Raises
        ``ConcurrentWrite`` (and publishes nothing) if another writer changed
        what this one relied on."""
        head = self.base
        while True:
            state = self._on_top_of(head)
            if self.store.files.create(_manifest(state.version), state.to_json()):
                break
            head = self.store.state()
        self._clean(state)
        return state.version

    def _on_top_of(self, head: State) -> State:
        now, tables = time.time(), dict(head.tables)
        dropped = dict(head.dropped)
        for name in set(self._out) | set(self._met):
            if name not in self.tables:
                continue
            mine, base = self.tables[name], self.base.tables.get(name)
            theirs = head.tables.get(name)
            were = {s.dir: s for s in base.segments} if base else {}
            are = {s.dir: s for s in theirs.segments} if theirs else {}
            gone = self._out.get(name, set()) & were.keys()
            changed = [s for d, s in (were | are).items() if (d in were) != (d in are)]
            if not gone <= are.keys() or any(self._relies_on(name, s) for s in changed):
                raise ConcurrentWrite(f"{name!r} under {self.store.root} was changed by "
                                      "another writer")
            added = [s for s in mine.segments if s.dir not in were]
            names = theirs.schema.names if theirs else []
            schema = StructType((theirs.schema.fields if theirs else []) + [
                f for f in mine.schema.fields if f.name not in names])
            tables[name] = replace(mine, schema=schema, segments=tuple(
                s for d, s in are.items() if d not in gone) + tuple(added))
            dropped.update({d: now for d in gone})
            self._keep |= {s.dir for s in added}
        recent = {d: at for d, at in dropped.items() if at >= now - self.store.grace}
        self._over = [d for d in dropped if d not in recent]
        return State(head.version + 1, tables, {**head.values, **self.values}, recent)

    def _relies_on(self, name: str, other: Segment) -> bool:
        return any(m is EVERYWHERE or (m.part == other.part and m.meets(other.lo, other.hi))
                   for m in self._met.get(name, ()))

    def _clean(self, state: State) -> None:
        """Delete what this write left over, what was dropped before the grace
        period and old manifests.  The state is published: a failure here
        leaves files behind and nothing else."""
        files, used = self.store.files, {d.split("/")[1] for d in self._keep}
        still = {d.split("/")[1] for t in state.tables.values() for d in (s.dir for s in t.segments)}
        still |= {d.split("/")[1] for d in state.dropped}
        # a write's whole folder goes with its last partition
        over = {d if d.split("/")[1] in still else "/".join(d.split("/")[:2]) for d in self._over}
        over |= {f for f in self._mine if f.split("/")[1] not in used}
        for name in over:
            files.delete(name)
        if state.version > KEEP_MANIFESTS:
            files.delete(_manifest(state.version - KEEP_MANIFESTS))

    def abandon(self) -> None:
        """Delete what was written for a transaction that was not published."""
        for name in self._mine:
            self.store.files.delete(name)


def _bounds(zone: Sequence[str]) -> list[Column]:
    """The least and greatest zone values and the rows that lack one."""
    if not zone:
        return []
    values = F.struct(*[F.col(c).cast("string").alias(c) for c in zone])
    lacks = F.lit(False)
    for c in zone:
        lacks = lacks | F.col(c).isNull()
    return [F.min(values).alias("lo"), F.max(values).alias("hi"), F.count_if(lacks).alias("lacks")]


def folder_bounds(stored: DataFrame, zone: Sequence[str]) -> DataFrame:
    """The zone's bounds in every data folder.  The set of flags in place of a
    count lets Spark aggregate by hash: by the bounds alone it sorts all rows."""
    lo, hi, lacks = _bounds(zone)
    absent = F.lit(False)
    for c in zone:
        absent = absent | F.col(c).isNull()
    return stored.groupBy(_folder()).agg(
        lo, hi, F.array_contains(F.collect_set(absent), True).alias("lacks"))


def merged_in_ranges(old: DataFrame, new: DataFrame, partition_by: Sequence[str],
                     keys: Sequence[str], tasks: int) -> DataFrame:
    """Rows of ``new`` and those of ``old`` whose (null-safe) keys are not in
    the same partition of ``new``, with their partition's label.

    One exchange, into ``tasks`` sorted ranges of partition and key: a range
    is as large whatever the table's size, and what leaves it is in order for
    the write.
    """
    rows = (old.withColumn(_NEW, F.lit(0)).unionByName(new.withColumn(_NEW, F.lit(1)))
            .withColumn(PART, _label_column(partition_by)))
    order = [PART, *keys]
    latest = F.max(_NEW).over(Window.partitionBy(*order))
    return (rows.repartitionByRange(max(1, tasks), *order).withColumn("__latest", latest)
            .where(F.col(_NEW) == F.col("__latest")).drop(_NEW, "__latest"))


def _zone(facts, zone: Sequence[str]) -> tuple:
    if not zone or facts["lo"] is None or facts["lacks"]:
        return None, None
    return tuple(facts["lo"]), tuple(facts["hi"])


def _folder() -> Column:
    """The data folder of a row's file, as manifests name it."""
    return F.regexp_extract("_metadata.file_path", f"(data/[0-9a-f]+/{PART}=[^/]+)/[^/]*$", 1
                            ).alias("folder")
