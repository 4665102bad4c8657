"""Operator 5: law, slots, groups, hot texts, edge cases."""

import zlib
from collections import Counter, defaultdict

from clickwin.llm.queries import LLM_QUERIES
from clickwin.llm.sharding import shard_documents


def size(text):
    return len((text or "").encode()) + 16


def check_slots(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_bytes_are_near_equal_and_groups_stay(spark):
    rows = LLM_QUERIES["op5_sharding"](spark, "/root/testdata/sf0.01").collect()
    text = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    load = Counter()
    for r in rows:
        t = text[r.doc_id]
        assert (r.size, r.text_crc32, r.law) == (size(t), zlib.crc32((t or "").encode()), "bytes")
        load[r.shard] += r.size
    most = max(size(t) for t in text.values())
    mean = sum(load.values()) / 40
    assert set(load) <= set(range(40)) and all(abs(v - mean) <= most + 0.01 * mean for v in load.values())
    check_slots(rows)


def test_hot_text_is_split_evenly(spark):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "case when id % 3 = 0 then repeat('hot ', 25) else repeat(id || ' ', 20) end as text")
    for lanes in (1 << 30, 2000):
        rows = shard_documents(docs, 7, lane_bytes=lanes).collect()
        load = Counter()
        for r in rows:
            load[r.shard] += r.size
        mean = sum(load.values()) / 7
        assert len(load) == 7 and max(load.values()) - min(load.values()) < 0.05 * mean
        check_slots(rows)


def test_small_groups_of_copies_stay_together(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "repeat('t' || (id div 3) || ' ', 30) as text")
    shards = defaultdict(set)
    for r in shard_documents(docs, 10).collect():
        shards[r.text].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_edge_cases(spark):
    rows = [(1, None, 5, "a"), (2, "", 5, "b"), (None, "x", 5, "c"), (3, "ä" * 9, 5, "d"),
            (3, "ä" * 9, 5, "d"), (4, "y" * 200_000, 5, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, lane__ string")
    out = shard_documents(docs, 4)
    assert out.columns == ["doc_id", "text", "lane__", "size", "text_crc32", "shard", "slot"]
    got = out.collect()
    assert sorted((r.size for r in got)) == sorted(size(t) for _, t, *_ in rows)
    assert sorted(r.lane__ for r in got) == ["a", "b", "c", "d", "d", "e"]
    check_slots(got)
    assert shard_documents(docs.limit(0), 4).count() == 0
    assert [r.slot for r in shard_documents(docs.limit(1), 40).collect()] == [0]


def test_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = {tuple(r) for r in shard_documents(docs).select("doc_id", "shard", "slot").collect()}
    assert a == {tuple(r) for r in shard_documents(docs).select("doc_id", "shard", "slot").collect()}
