"""Operator 2: planted copies, edits, clean texts, alignment, edge cases."""

import random

import numpy as np

from clickwin.llm import decontaminate as dc


def sw_brute(text, item):
    h = [[0] * (len(item) + 1) for _ in range(len(text) + 1)]
    best = 0
    for i in range(1, len(text) + 1):
        for j in range(1, len(item) + 1):
            s = dc.MATCH if text[i - 1] == item[j - 1] and text[i - 1] else dc.MISMATCH
            h[i][j] = max(0, h[i - 1][j - 1] + s, h[i - 1][j] + dc.GAP, h[i][j - 1] + dc.GAP)
            best = max(best, h[i][j])
    return best


def test_alignment_equals_the_textbook():
    rng = np.random.default_rng(7)
    for _ in range(60):
        a, b = rng.integers(0, 5, rng.integers(1, 25)), rng.integers(1, 5, rng.integers(1, 12))
        assert dc.smith_waterman(a, b)[0] == sw_brute(a.tolist(), b.tolist())


def table(spark, rows, cols):
    return spark.createDataFrame(rows, cols)


def test_copies_and_edits_are_caught_and_clean_texts_left(spark):
    rng = random.Random(2)
    word = lambda: f"v{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(14, 50)))) for i in range(30)]
    docs, want = [], set()
    for d in range(200):
        body = [word() for _ in range(rng.randrange(20, 400))]
        if d % 4 == 0:
            k = rng.randrange(30)
            passage = items[k][1].split()
            for _ in range(len(passage) // 8):         # substitutions, losses, insertions
                at = rng.randrange(len(passage))
                passage[at:at + rng.choice([0, 1])] = [word()] * rng.choice([0, 1])
            cut = rng.randrange(len(body))
            body[cut:cut] = passage
            want.add((d, k))
        docs.append((d, ", ".join(body).upper(), "x", 0.0))
    docs += [(900 + i, items[3][1], "x", 0.0) for i in range(120)]      # a passage many share
    want |= {(900 + i, 3) for i in range(120)}
    got = dc.contaminated(table(spark, docs, "doc_id long, text string, item_id string, score double"),
                          table(spark, items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    text = dict((d, t) for d, t, *_ in docs)
    for r in got:
        span = dc.tokens(text[r.doc_id])[r.first_word:r.last_word + 1]
        assert len(set(span) & set(items[r.item_id][1].split())) >= 0.5 * len(span) and r.score <= 1


def test_documents_hold_planted_items(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    norm = {r.item_id: " ".join(dc.tokens(r.text)) for r in bench.collect()}
    exact = {(r.doc_id, i) for r in docs.collect() for i, t in norm.items()
             if t in " ".join(dc.tokens(r.text))}
    got = {(r.doc_id, r.item_id): r.score for r in dc.contaminated(docs, bench).collect()}
    assert exact <= set(got) and exact
    clean = dc.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == docs.count() - len({d for d, _ in got})


def test_edge_cases(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    docs = [(1, None), (2, ""), (3, item), (3, item), (None, item), (4, "w " * 200_000 + item),
            (5, "alpha beta")]
    items = [(7, item), (7, item), (8, None), (9, ""), (10, "alpha beta"), (None, item)]
    d = table(spark, docs, "doc_id long, text string")
    b = table(spark, items, "item_id long, text string")
    got = dc.contaminated(d, b).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.score) for r in got) == [
        (0, 7, 1.0), (3, 7, 1.0), (3, 7, 1.0), (4, 7, 1.0)]
    # rows are dropped by their own text, whatever their ids are
    more = d.unionByName(table(spark, [(None, "clean"), (3, "clean too"), (None, None)],
                               "doc_id long, text string"))
    assert sorted(((r.doc_id, r.text) for r in dc.decontaminate(more, b).collect()), key=repr) == \
        sorted([(1, None), (2, ""), (5, "alpha beta"), (None, "clean"), (3, "clean too"),
                (None, None)], key=repr)
    assert dc.decontaminate(d, b.limit(0)).count() == d.count()
    assert dc.contaminated(d.limit(0), b).count() == 0 and dc.contaminated(d, b.limit(0)).count() == 0


def test_items_in_slices(spark, monkeypatch):
    monkeypatch.setattr(dc, "MAX_ITEM_BYTES", 200)
    items = [(i, " ".join(f"s{i}x{j}" for j in range(10))) for i in range(12)]
    docs = table(spark, [(i, t) for i, t in items], "doc_id long, text string")
    got = dc.contaminated(docs, table(spark, items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i in range(12)]


def test_a_few_common_words_are_no_copy_of_a_short_item(spark):
    items = table(spark, [(1, "what is the name of it"), (2, "the cat sat")],
                  "item_id long, text string")
    docs = table(spark, [(1, "she asked what is the name he bore"), (2, "what is the name of it"),
                         (3, "the cat sat down"), (4, "the cat ran")], "doc_id long, text string")
    got = dc.contaminated(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.score) for r in got) == [(2, 1, 1.0), (3, 2, 1.0)]


def test_a_passage_is_cut_out_from_its_earliest_start():
    item = [f"w{i}" for i in range(40)]
    item[30:33] = item[:3]                      # a seed at both ends of the item
    items = dc.Items([(1, " ".join(item))])
    text = "x " * 100 + " ".join(["y"] * 30 + item[30:])        # its first words are lost
    (a, b), = items.passages(items.encode(dc.tokens(text)))[0]
    assert a <= 100 and b >= 140
