"""Operator 2: items in scripts without spaces."""

from clickwin.llm import decontaminate as dc


def test_unspaced_items_are_found_and_may_be_edited(spark):
    item = "水在标准大气压下的沸点是多少度"
    docs = spark.createDataFrame(
        [(1, "前面的话" + item + "后面的话"), (2, item.replace("标", "表")), (3, "今天天气很好我们去公园散步吧")],
        "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r.score for r in dc.contaminated(docs, bench).collect()}
    assert got.keys() == {1, 2} and got[1] == 1.0
    assert dc.tokens("Über 日本x ok_1") == ["über", "日", "本", "x", "ok_1"]
