import os

import pytest
from pyspark.sql import functions as F

from clickwin.operators import upsert as up

CLICK = "UDID string, event string, time string, imei string"


def _rows(df, key):
    return sorted(tuple(r) for r in df.orderBy(key).collect())


def test_last_write_of_a_key_wins(spark):
    # tuples from the reference demo; UDID is the key, 0005 is written twice
    batch = spark.createDataFrame([("0005", "Zhang San", "20", "70"), ("0006", "Li Si", "20", "82"),
                                   ("0005", "Wang Wu", "19", "90")], CLICK)
    batch = batch.withColumn("seq", F.monotonically_increasing_id())
    merged = up.merge_upsert(spark.createDataFrame([], batch.schema),
                             up.dedupe_latest(batch, ["UDID"], ["seq"]), ["UDID"])
    got = {r["UDID"]: r["event"] for r in merged.collect()}
    assert got == {"0005": "Wang Wu", "0006": "Li Si"}


def test_upsert_replaces_inserts_keeps(spark):
    old = spark.createDataFrame([("0007", "a", "1", "x"), ("0008", "b", "2", "y")], CLICK)
    new = spark.createDataFrame([("0007", "c", None, "z"), ("0009", "d", "4", "w")], CLICK)
    got = _rows(up.merge_upsert(old, new, ["UDID"]), "UDID")
    # a null in the batch overwrites (presence is by column list, not by value)
    assert got == [("0007", "c", None, "z"), ("0008", "b", "2", "y"), ("0009", "d", "4", "w")]


def test_partial_column_upsert(spark):
    old = spark.createDataFrame([("0007", "a", "1", "x")], CLICK)
    new = spark.createDataFrame([("0007", "c"), ("0010", "e")], "UDID string, event string")
    got = _rows(up.merge_upsert(old, new, ["UDID"]), "UDID")
    assert got == [("0007", "c", "1", "x"), ("0010", "e", None, None)]


def test_null_safe_keys(spark):
    schema = "k1 string, k2 string, v string"
    old = spark.createDataFrame([(None, "a", "old"), ("x", None, "old2")], schema)
    new = spark.createDataFrame([(None, "a", "new")], schema)
    got = sorted((r["k1"] or "-", r["k2"] or "-", r["v"]) for r in
                 up.merge_upsert(old, new, ["k1", "k2"]).collect())
    assert got == [("-", "a", "new"), ("x", "-", "old2")]


def test_ragged_maps_widest_first(spark):
    maps = spark.createDataFrame(
        [(1, {"a": "1", "b": "2"}), (2, {"a": "3", "c": "4"}), (3, {"a": "5"}),
         (4, {"z": "9"})], "ord int, m map<string,string>")
    cols = up.widest_map_keys(maps, "m", ["ord"])
    assert cols == ["a", "b"]  # first of the two widest maps
    rows = [tuple(r) for r in up.ragged_maps_to_rows(maps, "m", ["ord"]).collect()]
    assert sorted(rows, key=str) == sorted([("1", "2"), ("3", None), ("5", None),
                                           (None, None)], key=str)


def test_delete_update_affected(spark):
    df = spark.createDataFrame([("1", "ios"), ("2", None), ("3", "android")], "ID string, P string")
    assert sorted(r["ID"] for r in up.delete_where(df, F.col("P") == "ios").collect()) == ["2", "3"]
    upd = up.update_where(df, {"P": F.lit("web")}, F.col("P").isNull())
    assert sorted(tuple(r) for r in upd.collect()) == [("1", "ios"), ("2", "web"), ("3", "android")]
    assert up.affected(df, F.col("P").isNull()).first()["AFFECTED"] == 1


def test_write_upsert_rerun_is_noop(spark, tmp_root):
    path = os.path.join(tmp_root, "stat")
    batch = spark.createDataFrame([("2024010101", "a", 3), ("2024010101", "b", 1)],
                                  "ENDTIME string, WORD string, FREQUENCY bigint")
    up.write_upsert(spark, path, batch, ["ENDTIME", "WORD"], ["ENDTIME"])
    first = _rows(up.read_table(spark, path, ["ENDTIME"]).select(
        "ENDTIME", "WORD", "FREQUENCY"), "WORD")
    up.write_upsert(spark, path, batch, ["ENDTIME", "WORD"], ["ENDTIME"])
    again = _rows(up.read_table(spark, path, ["ENDTIME"]).select(
        "ENDTIME", "WORD", "FREQUENCY"), "WORD")
    assert first == again
    # another window leaves the first partition untouched; an update replaces
    more = spark.createDataFrame([("2024010102", "a", 5), ("2024010101", "a", 4)],
                                 "ENDTIME string, WORD string, FREQUENCY bigint")
    up.write_upsert(spark, path, more, ["ENDTIME", "WORD"], ["ENDTIME"])
    got = _rows(up.read_table(spark, path, ["ENDTIME"]).select(
        "ENDTIME", "WORD", "FREQUENCY"), "WORD")
    assert sorted(got) == [("2024010101", "a", 4), ("2024010101", "b", 1),
                           ("2024010102", "a", 5)]
    assert dict(up.read_table(spark, path, ["ENDTIME"]).dtypes)["ENDTIME"] == "string"


def test_positional_and_upper(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    assert up.positional(df, ["WORD", "FREQUENCY"]).columns == ["WORD", "FREQUENCY"]
    assert up.upper_columns(df).columns == ["X", "Y"]


def test_rerun_reads_only_touched_partition(spark, tmp_root):
    path = os.path.join(tmp_root, "stat2")
    schema = "ENDTIME string, WORD string, FREQUENCY bigint"
    for end in ("2024010101", "2024010102", "2024010103"):
        up.write_upsert(spark, path, spark.createDataFrame([(end, "a", 1)], schema),
                        ["ENDTIME", "WORD"], ["ENDTIME"], unique=True, partition_values=[end])
    fix = spark.createDataFrame([("2024010102", "a", 7), ("2024010102", "b", 2)], schema)
    up.write_upsert(spark, path, fix, ["ENDTIME", "WORD"], ["ENDTIME"], unique=True,
                    partition_values=["2024010102"])
    got = sorted(tuple(r) for r in up.read_table(spark, path, ["ENDTIME"]).select(
        "ENDTIME", "WORD", "FREQUENCY").collect())
    assert got == [("2024010101", "a", 1), ("2024010102", "a", 7), ("2024010102", "b", 2),
                   ("2024010103", "a", 1)]
    old = up.read_partitions(spark, path, "ENDTIME", [path + "/ENDTIME=2024010102"])
    assert old.inputFiles() and all("ENDTIME=2024010102" in f for f in old.inputFiles())
    assert dict(old.dtypes)["ENDTIME"] == "string"


def test_null_safe_date_and_int_keys(spark):
    import datetime as dt
    schema = "d date, n int, v string"
    old = spark.createDataFrame([(None, None, "old"), (dt.date(2024, 1, 1), 1, "old1")], schema)
    new = spark.createDataFrame([(None, None, "new"), (dt.date(2024, 1, 2), None, "new2")],
                                schema)
    got = sorted((str(r["d"]), str(r["n"]), r["v"]) for r in
                 up.merge_upsert(old, new, ["d", "n"]).collect())
    assert got == [("2024-01-01", "1", "old1"), ("2024-01-02", "None", "new2"),
                   ("None", "None", "new")]
    partial = up.merge_upsert(old, new.select("d", "n", "v"), ["d", "n"], ["d", "n", "v"])
    assert partial.count() == 3


def test_cut_off_overwrite_is_repeated(spark, tmp_root, monkeypatch):
    """The job dies while the stored rows are being replaced."""
    path, schema = f"{tmp_root}/t", "ENDTIME string, WORD string, N int"
    up.write_upsert(spark, path, spark.createDataFrame([("d1", "a", 1), ("d1", "b", 2)], schema),
                    ["ENDTIME", "WORD"], ["ENDTIME"])
    real = up._write

    def dies(df, target, *rest):
        if target == path:
            up._delete_quietly(spark, f"{path}/ENDTIME=d1")     # old files gone, new ones not there
            raise RuntimeError("lost")
        return real(df, target, *rest)

    monkeypatch.setattr(up, "_write", dies)
    with pytest.raises(RuntimeError):
        up.write_upsert(spark, path, spark.createDataFrame([("d1", "a", 9)], schema),
                        ["ENDTIME", "WORD"], ["ENDTIME"])
    monkeypatch.setattr(up, "_write", real)
    assert up.recover(spark, path) and not up.recover(spark, path)
    got = sorted(tuple(r) for r in up.read_table(spark, path, ["ENDTIME"]).select(
        "ENDTIME", "WORD", "N").collect())
    assert got == [("d1", "a", 9), ("d1", "b", 2)]


def test_stored_delete_and_update_report_their_rows(spark, tmp_root):
    path, schema = f"{tmp_root}/t", "D string, K string, N int"
    rows = [("d1", "a", 1), ("d1", "b", 2), ("d2", "c", 3), ("d3", "e", None)]
    assert up.write_upsert(spark, path, spark.createDataFrame(rows, schema), ["K"], ["D"]) == 4
    assert up.write_upsert(spark, path, spark.createDataFrame([("d2", "c", 4), ("d2", "x", 5)], schema),
                           ["K"], ["D"]) == 2
    assert up.rewrite_where(spark, path, F.col("N") > 3, {"N": F.lit(0)}, ["D"]) == 2
    assert up.rewrite_where(spark, path, F.col("D") == "d2", partition_by=["D"]) == 2
    assert up.rewrite_where(spark, path, F.col("N") == 77, partition_by=["D"]) == 0
    got = sorted(map(tuple, up.read_table(spark, path, ["D"]).select("D", "K", "N").collect()), key=repr)
    assert got == [("d1", "a", 1), ("d1", "b", 2), ("d3", "e", None)]
    assert up.rewrite_where(spark, f"{tmp_root}/none", F.lit(True)) == 0


def test_ragged_union_and_dropped_entries(spark):
    maps = spark.createDataFrame([({"a": "1", "b": "2"},), ({"c": "3"},)], "m map<string,string>")
    assert up.ragged_maps_to_rows(maps, "m", [], union=True).columns == ["a", "b", "c"]
    assert up.dropped_entries(maps, "m", ["a", "b"]).first()[0] == 1
