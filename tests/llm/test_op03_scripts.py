"""Operator 3: languages in scripts of many characters, no merged symbols."""

import random

from clickwin.llm import language_id as li


def test_languages_of_large_scripts_are_told_apart(spark):
    rng = random.Random(4)
    # four languages of 1,500 characters each out of one block, frequent Latin text beside them
    letters = {f"l{k}": [chr(0x4E00 + 4 * i + k) for i in range(1500)] for k in range(4)}
    text = lambda k: "".join(rng.choice(letters[k]) for _ in range(400))
    rows = [(i, text(k), k) for i, k in enumerate(list(letters) * 60)]
    rows += [(1000 + i, " ".join(rng.choices(["the", "quick", "fox", "house"], k=3000)), "en")
             for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = li.predict(docs.withColumn("held_out", li.held_out("doc_id")), li.fit(docs),
                     ("held_out", "lang")).where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.95 * len(out)


def test_every_character_stands_for_itself():
    assert len(li.Grams([97])("bc bd")) == len({"b", "c", " ", "d", "bc", "c ", " b", "bd", "bc ", "c b", " bd"})
    assert len(li.Grams()("")) == 0
