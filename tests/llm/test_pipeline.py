"""The pipeline: stages against the operators, planted rows, edge cases."""

import corpus_pipeline as cp
from clickwin.llm import decontaminate as dc

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def planted(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    one = docs.orderBy("doc_id").first().text
    return docs.unionByName(spark.createDataFrame(
        [(90001, None, "en", "src1", 0), (90002, "12 34 !", "en", "src1", 7),
         (90003, one, "en", "src1", 9), (90004, one + " more", "en", "src1", 9),
         (90005, item, "en", "src1", 9)], docs.schema))


def test_stages_take_effect_and_keep_clean_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = planted(spark, sf)
    seen = {}
    for name, stage in cp.STAGES:
        out = cp.materialize(stage(spark, docs, sf), "test-" + name)
        assert out.columns[:5] == COLUMNS
        if name != "sharding":
            assert out.columns == COLUMNS
        before, after = ({r.doc_id for r in d.select("doc_id").collect()} for d in (docs, out))
        assert after <= before
        seen[name] = (before, after)
        docs = out
    assert seen["language_id"][0] - seen["language_id"][1] == {90001, 90002}
    assert {90003, 90004} <= seen["near_dedup"][0] - seen["near_dedup"][1]
    assert 90005 not in seen["decontamination"][1]
    # what decontamination drops holds an item's passage
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    gone = seen["decontamination"][0] - seen["decontamination"][1]
    leaks = dc.contaminated(planted(spark, sf), bench).collect()
    assert gone <= {r.doc_id for r in leaks}
    assert {r.shard for r in docs.collect()} <= set(range(cp.SHARDS))


def test_run_gives_the_last_stage(spark):
    out = cp.run(spark, "/root/testdata/sf0.001")
    assert out.columns == COLUMNS + ["size", "text_crc32", "shard", "slot"] and out.count() > 100


def test_empty_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0
