"""Cell store in key regions: only hit regions are rewritten, scans prune, big regions split."""

import pytest
from pyspark.sql import functions as F

from clickwin.operators import upsert as up
from clickwin.sources import snapshots as sn
from clickwin.sources.cellstore import KEYS, CellStore, region_of


def cells_of(spark, n, value="v"):
    return spark.range(n).select(
        F.format_string("%04d", F.col("id")).alias("rowkey"), F.lit("info").alias("family"),
        F.explode(F.array(F.lit("A"), F.lit("B"))).alias("qualifier"),
        F.concat(F.lit(value), F.col("id").cast("string")).alias("value"))


def stored(store):
    return {(r["rowkey"], r["qualifier"]): r["value"] for r in store.scan().collect()}


def test_upsert_rewrites_hit_regions_only(spark, tmp_root):
    store = CellStore(spark, tmp_root)
    assert store.load(cells_of(spark, 200), regions=4) == 400
    before = store.regions()
    assert len(before) == 4 and all(a.hi < b.lo for a, b in zip(before, before[1:]))
    batch = cells_of(spark, 200, "w").where("rowkey in ('0003', '0004') and qualifier = 'A'")
    assert store.upsert(batch.unionByName(batch)) == 2              # a repeated row counts once
    after = store.regions()
    assert len(set(before) & set(after)) == 3 and len(after) == 4
    want = {(f"{i:04d}", q): f"{'w' if i in (3, 4) and q == 'A' else 'v'}{i}"
            for i in range(200) for q in "AB"}
    assert stored(store) == want
    with pytest.raises(ValueError):
        store.load(cells_of(spark, 1))


def test_keys_below_and_above_all_regions_find_one(spark, tmp_root):
    store = CellStore(spark, tmp_root)
    store.load(cells_of(spark, 50), regions=3)
    new = spark.createDataFrame([("", "info", "A", "low"), ("~", "info", "A", "high"),
                                 ("0010", "info", "", "odd")],
                                "rowkey string, family string, qualifier string, value string")
    assert store.upsert(new) == 3
    got = stored(store)
    assert len(got) == 103
    assert (got["", "A"], got["~", "A"], got["0010", ""]) == ("low", "high", "odd")


def test_scan_lists_regions_in_range_and_pushes_the_bounds(spark, tmp_root):
    store = CellStore(spark, tmp_root)
    store.load(cells_of(spark, 200), regions=8)
    store.upsert(cells_of(spark, 200, "w").where("rowkey < '0020'"))
    rows = store.scan("0100", "0110", "info")
    assert {r["rowkey"] for r in rows.collect()} == {f"{i:04d}" for i in range(100, 110)}
    assert len(rows.inputFiles()) <= 2 < len(store.scan().inputFiles())
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rowkey,0100)" in plan and "LessThan(rowkey,0110)" in plan
    # files of a rewritten region are sorted again
    first = [r["rowkey"] for r in spark.read.parquet(
        f"{tmp_root}/{store.regions()[0].dir}").select("rowkey").collect()]
    assert first == sorted(first)


def test_grown_region_is_split_between_other_regions(spark, tmp_root):
    store = CellStore(spark, tmp_root, region_bytes=4000)
    store.load(cells_of(spark, 40), regions=2)
    many = cells_of(spark, 4000, "long value ").withColumn(
        "rowkey", F.concat(F.lit("0005."), "rowkey"))
    assert store.upsert(many) == 8000
    regions = store.regions()
    assert len(regions) > 3 and all(a.hi < b.lo for a, b in zip(regions, regions[1:]))
    assert len(stored(store)) == 8080


def test_row_wider_than_a_region_spans_regions(spark, tmp_root):
    store = CellStore(spark, tmp_root)
    wide = spark.range(300).select(F.lit("one").alias("rowkey"), F.lit("info").alias("family"),
                                   F.format_string("q%03d", F.col("id")).alias("qualifier"),
                                   F.lit("x").alias("value"))
    store.load(wide, regions=3)
    assert len(store.regions()) == 3
    assert store.upsert(wide.where("qualifier = 'q150'").withColumn("value", F.lit("y"))) == 1
    assert stored(store)["one", "q150"] == "y" and store.scan("one", "onf").count() == 300


def test_empty_store_and_batch(spark, tmp_root):
    store = CellStore(spark, tmp_root)
    assert store.upsert(cells_of(spark, 0)) == 0 and stored(store) == {}
    assert store.upsert(cells_of(spark, 3)) == 6
    assert store.upsert(cells_of(spark, 0)) == 0 and len(stored(store)) == 6


@pytest.mark.parametrize("n", [0, 1, 2, 7, 30])
def test_region_of_equals_search(spark, n):
    from bisect import bisect_right
    bounds = [(f"{3 * i + 3:04d}", "B" if i % 2 else "A") for i in range(n)]
    labels = [f"r{i}" for i in range(n + 1)]
    got = cells_of(spark, 100).select("rowkey", "qualifier", region_of(bounds, labels)).collect()
    assert all(r[2] == labels[bisect_right(bounds, (r[0], r[1]))] for r in got)


def test_regions_follow_the_bytes_not_the_shuffle_partitions(spark, tmp_root):
    # 1,600 cells of about 30 bytes; the session has 8 shuffle partitions
    store = CellStore(spark, tmp_root, region_bytes=1000)
    assert store.load(cells_of(spark, 800)) == 1600
    assert len(store.regions()) > 16


def test_merge_is_one_exchange_and_equals_the_anti_join(spark):
    kind = "rowkey string, family string, qualifier string, value string, REGION string"
    old = spark.createDataFrame(
        [(f"k{i:03}", "info", "Q", f"old{i}", f"r{i // 50}") for i in range(100)]
        + [(None, "info", "Q", "old", "r0"), (None, "info", None, "old", "r0"),
           ("k099", "info", "Q", "again", "r1")], kind)            # a key stored twice stays so
    new = spark.createDataFrame(
        [(f"k{i:03}", "info", "Q", f"new{i}", f"r{i // 50}") for i in range(0, 120, 7)]
        + [(None, "info", "Q", "new", "r0"), ("k000", "info", "Q", "twin", "r0")], kind)
    got = sn.merged_in_ranges(old, new, ["REGION"], KEYS, 5)
    plan = got.sortWithinPartitions(sn.PART, *KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1
    want = up.merge_upsert(old, new, KEYS)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_bounds_of_folders_need_no_sort(spark, tmp_root):
    store = CellStore(spark, tmp_root)
    store.load(cells_of(spark, 200), regions=4)
    files = spark.read.parquet(*[f"{tmp_root}/{s.dir}" for s in store.regions()])
    found = sn.folder_bounds(files, ["rowkey", "qualifier"])
    assert "Sort" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r.folder, tuple(r.lo), tuple(r.hi), r.lacks) for r in found.collect()} == {
        (s.dir, s.lo, s.hi, False) for s in store.regions()}
