"""Stores published by manifests: isolation, faults, two writers, odd values."""

import json

import pytest
from pyspark.sql import functions as F

from clickwin.plans import incremental as inc
from clickwin.sources import snapshots as sn
from clickwin.sources.snapshots import ConcurrentWrite, Store, Table
from pyspark.sql.types import StructType

SCHEMA = "D string, K string, N int"
BY_DAY = Table(StructType(), ("D",))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows_of(store, name="t"):
    return sorted((tuple(r) for r in store.read(name).select("D", "K", "N").collect()), key=repr)


def put(store, *rows, keys=("K",), **kw):
    return store.run(lambda tx: tx.upsert("t", frame(store.spark, *rows), list(keys), BY_DAY, **kw))


def test_null_and_odd_partitions_keep_their_rows(spark, tmp_root):
    store = Store(spark, tmp_root)
    odd = [(None, "a", 1), (None, "b", 2), ("", "c", 3), ("x:1", "d", 4), ("x:1", "e", 5),
           ("é/%=", "f", 6), ("n", "g", 7)]
    assert put(store, *odd) == 7
    assert put(store, (None, "b", 20)) == 1
    want = sorted([*odd[:1], (None, "b", 20), *odd[2:]], key=repr)
    assert rows_of(store) == want
    assert store.run(lambda tx: tx.rewrite("t", F.col("K") == "a")) == 1
    assert store.run(lambda tx: tx.rewrite("t", F.col("K").isin("d", "e"))) == 2
    assert store.run(lambda tx: tx.rewrite("t", F.col("K") == "gone")) == 0
    assert store.run(lambda tx: tx.rewrite("t", F.col("D") == "n", {"N": F.lit(70)})) == 1
    assert rows_of(store) == sorted([(None, "b", 20), ("", "c", 3), ("é/%=", "f", 6),
                                     ("n", "g", 70)], key=repr)


def test_moved_keys_are_there_once(spark, tmp_root):
    store = Store(spark, tmp_root)
    put(store, ("d1", "a", 1), ("d1", "b", 2), ("d2", "c", 3), (None, "z", 9))
    assert put(store, ("d2", "a", 10), ("d3", None, 5), ("d1", "z", 90)) == 3
    assert rows_of(store) == sorted([("d1", "b", 2), ("d1", "z", 90), ("d2", "a", 10),
                                     ("d2", "c", 3), ("d3", None, 5)], key=repr)
    # the partition that lost its only row has no folder any more
    assert {s.part for s in store.table("t").segments} == {("d1",), ("d2",), ("d3",)}
    assert put(store, ("d3", "a", 11), (None, None, 6)) == 2
    assert rows_of(store) == sorted([("d1", "b", 2), ("d1", "z", 90), ("d3", "a", 11),
                                     ("d2", "c", 3), (None, None, 6)], key=repr)


def test_partial_columns_and_new_columns(spark, tmp_root):
    store = Store(spark, tmp_root)
    put(store, ("d1", "a", 1), ("d2", "b", 2))
    part = spark.createDataFrame([("d1", "a", "x"), ("d9", "n", "y")], "D string, K string, M string")
    store.run(lambda tx: tx.upsert("t", part, ["K"]))
    got = sorted(map(tuple, store.read("t").select("D", "K", "N", "M").collect()))
    assert got == [("d1", "a", 1, "x"), ("d2", "b", 2, None), ("d9", "n", None, "y")]
    with pytest.raises(ValueError):
        store.run(lambda tx: tx.upsert("t", part.select("K"), ["K"]))


def test_reader_in_the_middle_of_a_write_sees_the_old_rows(spark, tmp_root):
    store = Store(spark, tmp_root)
    put(store, ("d1", "a", 1), ("d2", "b", 2))
    before = store.read("t")
    tx = Store(spark, tmp_root).begin()
    tx.upsert("t", frame(spark, ("d1", "a", 5), ("d3", "c", 3)), ["K"])
    assert rows_of(store) == [("d1", "a", 1), ("d2", "b", 2)]       # written, not published
    tx.commit()
    assert rows_of(store) == [("d1", "a", 5), ("d2", "b", 2), ("d3", "c", 3)]
    # a reader that planned before the commit still reads what it planned
    assert sorted(map(tuple, before.select("D", "K", "N").collect())) == [("d1", "a", 1), ("d2", "b", 2)]


@pytest.mark.parametrize("step", ["_write", "create"])
@pytest.mark.parametrize("nth", [1, 2])
def test_death_at_any_step_leaves_old_or_new(spark, tmp_root, monkeypatch, step, nth):
    store = Store(spark, tmp_root)
    put(store, ("d1", "a", 1), ("d1", "b", 2))
    owner, calls = (sn.Transaction, []) if step == "_write" else (sn.Files, [])
    real = getattr(owner, step)

    def dies(self, *args, **kw):
        calls.append(1)
        if step == "create" and nth == 2:
            real(self, *args, **kw)         # the manifest is there, the writer dies after it
            raise RuntimeError("lost")
        if step == "create":
            raise RuntimeError("lost")
        out = real(self, *args, **kw)
        if len(calls) == nth:               # the folder is there, the writer dies after it
            raise RuntimeError("lost")
        return out

    monkeypatch.setattr(owner, step, dies)
    with pytest.raises(RuntimeError):
        put(store, ("d1", "a", 9))
    monkeypatch.setattr(owner, step, real)
    published = step == "create" and nth == 2
    assert rows_of(store) == [("d1", "a", 9 if published else 1), ("d1", "b", 2)]
    assert put(store, ("d1", "a", 9)) == 1                          # the rerun
    assert rows_of(store) == [("d1", "a", 9), ("d1", "b", 2)]
    # what the dead writer left is found and deleted, nothing that is named is
    assert Store(spark, tmp_root, grace=-5).vacuum() >= (0 if published else 1)
    assert rows_of(store) == [("d1", "a", 9), ("d1", "b", 2)]


def test_two_writers_are_both_kept_or_one_is_refused(spark, tmp_root):
    store = Store(spark, tmp_root)
    keys = ["D", "K"]
    put(store, ("d1", "a", 1), ("d2", "b", 2), keys=keys)
    one, two = store.begin(), Store(spark, tmp_root).begin()
    one.upsert("t", frame(spark, ("d1", "a", 10)), keys)
    two.upsert("t", frame(spark, ("d2", "b", 20), ("d3", "c", 3)), keys)
    one.commit()
    two.commit()                                                    # other partitions: both kept
    assert rows_of(store) == [("d1", "a", 10), ("d2", "b", 20), ("d3", "c", 3)]
    one, two, three = store.begin(), store.begin(), store.begin()
    one.upsert("t", frame(spark, ("d1", "a", 11)), keys)
    two.upsert("t", frame(spark, ("d1", "x", 12)), keys)
    three.rewrite("t", F.col("N") == 3)
    one.commit()
    for late in (two, three):
        with pytest.raises(ConcurrentWrite):
            late.commit()
    assert rows_of(store) == [("d1", "a", 11), ("d2", "b", 20), ("d3", "c", 3)]
    # two writers that create the same new partition
    one, two = store.begin(), store.begin()
    for tx, n in ((one, 1), (two, 2)):
        tx.upsert("t", frame(spark, ("d4", "k", n)), keys)
    two.commit()
    with pytest.raises(ConcurrentWrite):
        one.commit()
    assert ("d4", "k", 2) in rows_of(store) and ("d4", "k", 1) not in rows_of(store)


def test_run_repeats_a_refused_write(spark, tmp_root):
    store, tries = Store(spark, tmp_root), []
    put(store, ("d1", "a", 1))

    def body(tx):
        tries.append(1)
        tx.upsert("t", frame(spark, ("d1", "b", 2)), ["K"])
        if len(tries) == 1:
            put(Store(spark, tmp_root), ("d1", "c", 3))             # another writer is faster

    store.run(body)
    assert len(tries) == 2
    assert rows_of(store) == [("d1", "a", 1), ("d1", "b", 2), ("d1", "c", 3)]


def test_batch_that_meets_no_zone_is_not_merged(spark, tmp_root):
    store = Store(spark, tmp_root)
    layout = Table(StructType(), ("D",), ("K",), each=True)     # bounds of every partition

    def write(*rows):
        store.run(lambda tx: tx.upsert("t", frame(spark, *rows), ["D", "K"], layout))
        return store.table("t").segments

    first = write(("d1", "a", 1), ("d1", "c", 2))
    second = write(("d1", "d", 3), ("d2", "a", 4))
    assert set(first) < set(second) and len(second) == 3            # left in place
    third = write(("d1", "b", 9))
    assert not set(first) & set(third) and len(third) == 3          # between a and c: merged
    assert rows_of(store) == [("d1", "a", 1), ("d1", "b", 9), ("d1", "c", 2), ("d1", "d", 3),
                              ("d2", "a", 4)]
    assert store.greatest("t", "K") == "d"
    # a null zone value hides nothing
    assert None in [s.hi for s in write(("d3", None, 1), ("d3", "q", 2))]
    write(("d3", None, 5))
    assert [r for r in rows_of(store) if r[0] == "d3"] == [("d3", "q", 2), ("d3", None, 5)] or \
        [r for r in rows_of(store) if r[0] == "d3"] == [("d3", None, 5), ("d3", "q", 2)]


def test_many_segments_are_merged_and_old_folders_go(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(sn, "MAX_SEGMENTS", 3)
    monkeypatch.setattr(sn, "KEEP_MANIFESTS", 4)
    store = Store(spark, tmp_root, grace=-1)
    layout = Table(StructType(), ("D",), ("K",))
    for i in range(8):
        store.run(lambda tx, i=i: tx.upsert("t", frame(spark, ("d1", f"k{i}", i)), ["K"], layout,
                                            fixed=True))
        assert len(store.table("t").segments) <= 3
    assert rows_of(store) == [("d1", f"k{i}", i) for i in range(8)]
    assert len(store.versions()) <= 4
    named = {s.dir.split("/")[1] for s in store.table("t").segments}
    there = {n for n, _ in store.files.names("data")}
    assert named <= there and len(there) <= len(named) + 5          # at most the last write's


def test_launch_publishes_rows_and_marker_together(spark, tmp_root, monkeypatch):
    store = inc.label_store(tmp_root)
    rows = spark.createDataFrame([("2024010101", "2024010100", "a", 1)],
                                 "ENDTIME string, STARTTIME string, WORD string, FREQUENCY bigint")
    real = sn.Files.create

    def dies(self, name, text):
        raise RuntimeError("lost")

    monkeypatch.setattr(sn.Files, "create", dies)
    with pytest.raises(RuntimeError):
        store.publish(spark, rows, inc.one_window(spark, "2024010100", "2024010101"))
    monkeypatch.setattr(sn.Files, "create", real)
    assert store.markers(spark) is None and store.last_end(spark) is None
    store.publish(spark, rows, inc.one_window(spark, "2024010100", "2024010101"))
    assert store.last_end(spark) == "2024010101" and store.results(spark).count() == 1
    assert store.store(spark).state().version == 1


def test_reading_writes_nothing(spark, tmp_root):
    store = inc.label_store(tmp_root)
    assert store.markers(spark) is None
    assert Store(spark, f"{tmp_root}/STAT_LABEL").versions() == []
    import os
    assert os.listdir(tmp_root) == []


def test_manifest_is_json(spark, tmp_root):
    store = Store(spark, tmp_root)
    put(store, (None, "a", 1))
    state = store.state()
    assert sn.State.from_json(state.to_json()) == state
    assert json.loads(state.to_json())["version"] == 1
