"""Operator 1 against the library on whole texts."""

import public_tokenizers
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clickwin.llm.token_counts import load_tokenizer, piece_counts, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", None, "Hello, world's <|endoftext|> end", "<|startoftext|>x<|ENDOFTEXT|> <|endoftext|>.",
         "a\x1cb\x85c d\xa0e", "é ́x  IİΣς", "你好 123 4.5\tx\r\ny",
         "x" * 70_000, "word " * 50_000, "\x00 ﻿\U0001f600\U0001f600", "don't we'll I'd"]


def expected(text):
    return len(Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_library(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], "x", 1), (None, "a b", "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, t int")
    got = sorted((tuple(r) for r in token_counts(docs, PATH, limit=100).collect()), key=repr)
    want = sorted(((i, len((t or "").encode()), expected(t), expected(t) > 100)
                   for i, t, *_ in rows), key=repr)
    assert got == want


def test_sample_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in token_counts(docs, PATH).collect()}
    assert got == {r.doc_id: expected(r.text) for r in docs.collect()}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out = token_counts(docs, PATH)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and out.count() == 0


@pytest.mark.parametrize("known", [{}, {b"the": 1}])
def test_piece_counts_remember(known):
    tok = load_tokenizer(PATH)
    first = piece_counts(tok, [b"the", b"unbelievably"], known).tolist()
    assert first == [expected("the"), expected("unbelievably")]
    assert piece_counts(tok, [b"unbelievably"], known).tolist() == first[1:]


@settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=60))
def test_sum_over_pretokens_is_the_text(text):
    tok = load_tokenizer(PATH)
    runs = text.encode().split()
    assert piece_counts(tok, runs, {}).sum() == expected(text)
