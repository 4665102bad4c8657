"""Operator 3: held-out accuracy, brute-force kernel and edge cases."""

import math
import zlib

import numpy as np

from clickwin.llm import language_id as li

DOCS = "/root/testdata/sf0.01/documents.parquet"


def grams(text, alphabet):
    s = [c if ord(c) in alphabet else "" for c in text.lower()]
    return {tuple(s[i:i + n]) for n in (1, 2, 3) for i in range(len(s) - n + 1)}


def test_held_out_accuracy_and_flag(spark):
    docs = spark.read.parquet(DOCS)
    out = li.predict(docs.withColumn("held_out", li.held_out("doc_id")), li.fit(docs),
                     ("doc_id", "held_out", "lang")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_scores_equal_the_kernel_expansion(spark):
    docs = spark.read.parquet(DOCS).limit(60)
    model = li.fit(docs)
    alphabet = set(model["alphabet"])
    g = li.Grams(model["alphabet"])
    a, b = (r.text for r in docs.select("text").limit(2).collect())
    for t in (a, b, "x", "xy", "Zz 你"):
        assert len(g(t)) == len(grams(t, alphabet))
    ka = len(set(g(a)) & set(g(b))) / math.sqrt(len(g(a)) * len(g(b)))
    kb = len(grams(a, alphabet) & grams(b, alphabet)) / math.sqrt(
        len(grams(a, alphabet)) * len(grams(b, alphabet)))
    assert ka == kb


def test_long_text_is_read_whole():
    g = li.Grams([ord(c) for c in "abc"])
    text = "a" * (li.CHUNK - 1) + "bc" + "a" * 10 + "cba"
    assert len(g(text)) == len(grams(text, {97, 98, 99}))


def test_edge_cases(spark):
    rows = [(1, None, "en", "s", 9), (2, "", "en", "s", 9), (3, "123 !?", "en", "s", 9),
            (4, "the house", "en", "s", 9), (4, "the house", "en", "s", 9), (None, "das Haus", None, "s", 9),
            (6, "das Haus", "de", "s", 9), (9, "w" * 300_000, None, "s", 9), (11, "the tree", "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, lang_pred int")
    out = li.predict(docs.withColumn("held_out", li.held_out("doc_id")), li.fit(docs),
                     ("doc_id", "held_out", "lang_pred")).collect()
    assert out[0].asDict().keys() == {"doc_id", "held_out", "lang_pred", "score"}
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert [by[i][0].lang_pred for i in (1, 2, 3)] == ["und"] * 3
    assert len(by[4]) == 2 and by[4][0] == by[4][1] and by[None][0].held_out is False
    assert by[9][0].lang_pred in ("en", "de")


def test_without_training_rows_and_empty(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert li.fit(docs) is None
    assert [(r.lang_pred, r.score) for r in li.predict(docs, None).collect()] == [("und", 0.0)]
    assert li.fit(docs.limit(0)) is None and li.predict(docs.limit(0), None).count() == 0


def test_language_and_source_are_no_inputs(spark):
    docs = spark.read.parquet(DOCS)
    model = li.fit(docs)
    same = docs.selectExpr("doc_id", "text", "'xx' as lang", "'yy' as source")
    a = {r.doc_id: (r.lang_pred, r.score) for r in li.predict(docs, model).collect()}
    assert a == {r.doc_id: (r.lang_pred, r.score) for r in li.predict(same, model).collect()}


def test_letters_are_unicode_letters_only():
    assert [li.has_letter(t) for t in ("x", "é", "你", "ª")] == [True] * 4
    assert not any(li.has_letter(t) for t in (None, "", "12 !", "½²Ⅷ_", "\u0301"))
