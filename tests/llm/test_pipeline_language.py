"""Language ID of the pipeline: foreign scripts and noise beside clean texts."""

import base64
import json
import random
import string

import corpus_pipeline as cp


def test_foreign_scripts_and_noise_are_dropped_and_clean_texts_kept(spark):
    sf, rng = "/root/testdata/sf0.01", random.Random(3)
    letters = " ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(3, 9)))
                       for _ in range(100))
    bad = ["Это простой текст на русском языке о погоде, природе и людях. " * 2,
           "今天天气很好我们去公园散步吧。然后一起吃午饭看电影。", "これは日本語の短い文章です。天気がとても良いです。",
           "هذا نص عربي بسيط عن الطقس والطبيعة والناس في المدينة", letters,
           base64.b64encode(rng.randbytes(600)).decode(),
           json.dumps([{"id": rng.randrange(10**6), f"k{i}": rng.random(), "flag": None}
                       for i in range(30)])]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    planted = docs.unionByName(spark.createDataFrame(
        [(9_000_000 + i, t, None, "src1", len(t)) for i, t in enumerate(bad)], docs.schema))
    kept = {r.doc_id for r in cp.identify_language(spark, planted, sf).select("doc_id").collect()}
    assert not {i for i in kept if i is not None and i >= 9_000_000}
    clean = {r.doc_id for r in docs.where("lang is not null and length(text) > 300").collect()}
    assert len(clean - kept) <= 0.002 * len(clean), len(clean - kept)
