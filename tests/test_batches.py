"""Keyed writes in numbered batches: count so far, failing batch, restart."""

import pytest
from pyspark.sql import functions as F

from clickwin.operators.batches import BatchFailed, by_key, progress, write_batches
from clickwin.sources.snapshots import Store


def records(spark, bad=None):
    # typed records; keys repeat within and across batches
    rows = [(f"k{i % 7}", i, i / 2, i // 10 + 1) for i in range(50)]
    df = spark.createDataFrame(rows, "K string, N int, X double, B int")
    return df if bad is None else df.withColumn("X", F.when(F.col("N") != bad, F.col("X")))


def run(store, rows):
    return write_batches(store, "t", rows.drop("B").withColumn("B2", F.col("N") % 3), ["K"], "job",
                         F.floor(F.col("N") / 10) + 1, ["N"], require=F.col("X").isNotNull())


def last(n):
    out = {}
    for i in range(n):
        out[f"k{i % 7}"] = i
    return out


def test_fault_in_batch_three_of_five_and_restart(spark, tmp_root):
    store = Store(spark, tmp_root)
    with pytest.raises(BatchFailed) as e:
        run(store, records(spark, bad=25))
    assert (e.value.batch, e.value.rows) == (3, 14)                 # seven keys a batch
    assert {r["K"]: r["N"] for r in store.read("t").collect()} == last(20)
    assert progress(store, "job") == (2, 14)
    version = store.state().version
    assert run(store, records(spark)) == 35                         # goes on with the third
    assert store.state().version == version + 3
    assert {r["K"]: r["N"] for r in store.read("t").collect()} == last(50)
    assert run(store, records(spark)) == 35                         # nothing is written twice
    assert store.state().version == version + 3


def test_writer_that_dies_after_publishing_does_not_repeat_its_batch(spark, tmp_root, monkeypatch):
    from clickwin.sources import snapshots as sn
    store, real, calls = Store(spark, tmp_root), sn.Files.create, []

    def dies(self, name, text):
        done = real(self, name, text)
        calls.append(name)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return done

    monkeypatch.setattr(sn.Files, "create", dies)
    with pytest.raises(BatchFailed):
        run(store, records(spark))
    monkeypatch.setattr(sn.Files, "create", real)
    assert progress(store, "job") == (2, 14)
    assert run(store, records(spark)) == 35


def test_batches_by_key_keep_a_key_together(spark, tmp_root):
    rows = records(spark).drop("B").unionByName(
        spark.createDataFrame([(None, 1, 1.0), (None, 2, 2.0)], "K string, N int, X double"))
    number = by_key(rows, ["K"], 10)
    per_key = rows.select("K", number.alias("B")).groupBy("K").agg(F.count_distinct("B").alias("n"))
    assert {r["n"] for r in per_key.collect()} == {1}
    store = Store(spark, tmp_root)
    assert write_batches(store, "t", rows, ["K"], "j", number, ["N"]) == 8
    assert {r["K"]: r["N"] for r in store.read("t").collect()} == last(50) | {None: 2}


def test_no_rows(spark, tmp_root):
    store = Store(spark, tmp_root)
    assert run(store, records(spark).where("false")) == 0 and store.table("t") is None
