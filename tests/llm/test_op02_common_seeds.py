"""Operator 2: a hot group that makes an item's own words common."""

from clickwin.llm import decontaminate as dc


def test_a_hot_group_with_half_an_item_is_found(spark):
    item = [f"w{i}" for i in range(28)]
    hot = [(i, " ".join([f"a{i}", *item[:14], f"b{i}"])) for i in range(300)]
    clean = [(1000 + i, " ".join(f"c{i}x{j}" for j in range(50))) for i in range(20)]
    docs = spark.createDataFrame(hot + clean, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r.score for r in dc.contaminated(docs, bench).collect()}
    assert got == {i: 0.5 for i, _ in hot}
    assert {r.doc_id for r in dc.decontaminate(docs, bench).collect()} == {i for i, _ in clean}
