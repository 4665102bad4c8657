"""Operator 8: contexts by absolute counts, to depth 3, against brute force."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from clickwin.llm import suffix_tree as st
from tests.llm.test_op08_suffix_tree import held, seq


class Brute:
    """The tree by its definition, contexts by count."""

    def __init__(self, rows, cfg):
        train = [seq(t) for i, t in rows if not held(i)]
        self.c = Counter(w for s in train for w in s)
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.states = {}
        for d in range(1, cfg.depth + 1):
            nxt = {}
            for s in train:
                for i in range(len(s) - d):
                    nxt.setdefault(tuple(s[i:i + d]), Counter())[s[i + d]] += 1
            new = {}
            for ctx, cnt in nxt.items():
                total = sum(cnt.values())
                p = {w: (k - cfg.discount) / total for w, k in cnt.items() if k >= 2}
                if total < cfg.min_count or not p:
                    continue
                low = {w: self.prob(ctx[1:], w) for w in p}
                rest, room = 1 - sum(p.values()), max(1 - sum(low.values()), 1e-12)
                kl = sum(p[w] * math.log(p[w] / low[w]) for w in p) + rest * math.log(
                    max(rest, 1e-300) / room)
                if kl >= cfg.divergence:
                    new[ctx] = (p, rest / room)
            self.states |= new

    def prob(self, ctx, w):
        while ctx and ctx not in self.states:
            ctx = ctx[1:]
        if not ctx:
            return (self.c[w] + 0.1) / (self.n + 0.1 * (self.v + 1))
        p, back = self.states[ctx]
        return p[w] if w in p else back * self.prob(ctx[1:], w)

    def score(self, text, depth):
        s = seq(text)
        return sum(math.log10(self.prob(tuple(s[max(0, k - depth):k]), w)) for k, w in enumerate(s))


def compare(spark, rows, cfg):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in st.lm_scores(docs, cfg).collect()}
    model = Brute(rows, cfg)
    assert got == pytest.approx({i: model.score(t, cfg.depth) for i, t in rows}, rel=1e-9)
    return model


def test_rare_contexts_of_a_large_corpus_are_states(spark, monkeypatch):
    monkeypatch.setattr(st, "BLOCK_BYTES", 20_000)      # their counts come from several blocks
    tail = ["red", "green", "blue"]
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(300))
             + (f" alpha beta gamma {tail[i // 2 % 2]} other beta gamma blue" if i % 2 else "")) for i in range(120)]
    model = compare(spark, rows, st.Settings())
    # all below the share that contexts once needed
    assert {("alpha",), ("gamma",), ("alpha", "beta", "gamma")} <= set(model.states)
    assert ("alpha", "beta") not in model.states        # no other than after "beta" alone
    assert max(k for w, k in model.c.items() if w) < 0.004 * model.n


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = compare(spark, [(r.doc_id, r.text) for r in docs.collect()], st.Settings())
    assert {len(c) for c in model.states} == {1, 2, 3}


@pytest.mark.parametrize("most", [None, 50, 1 << 62])
def test_first_places_of_distinct_values(most):
    x = np.random.default_rng(1).integers(0, 50, 5000)
    first, which = st.distinct(x, most)
    values, want, numbers = np.unique(x, return_index=True, return_inverse=True)
    assert x[first].tolist() == values.tolist() and first.tolist() == want.tolist()
    assert which.tolist() == numbers.tolist()
    assert [len(y) for y in st.distinct(x[:0], most)] == [0, 0]


def test_sums_over_a_context_come_from_the_first_blocks_that_have_its_grams(spark):
    """Every block has the same grams: one block sums them all."""
    arrow = st._arrow(spark, st.ASKED)
    key = np.sort(np.random.default_rng(2).integers(0, 1 << 60, 500).astype(np.uint64))
    asked = pa.Table.from_batches([st.batch_of(
        arrow, [1], [0], [block], [st.packed(np.diff(key, prepend=np.uint64(0)))],
        [st.packed(np.ones(500, np.int64))], [None], [None]) for block in (3, 1, 2)])
    rows = st._answer(asked, st._arrow(spark, st.TABLE), 0.01).to_pylist()
    assert {r["block"]: set(st.unpacked(r["body"]).tolist()) for r in rows} == {1: {7}, 2: {6}, 3: {6}}


def test_asked_grams_cost_few_bytes_and_words_are_dropped(spark, monkeypatch):
    answered, cost = st._answered, {}

    def spy(asked, *rest):
        for r in asked.select("kind", "key", "a", "b").where("kind % 2 = 1").collect():
            n, size = cost.get(r.kind, (0, 0))
            cost[r.kind] = n + len(st.unpacked(r.a)), size + len(r.key) + len(r.b or b"")
        return answered(asked, *rest)

    monkeypatch.setattr(st, "_answered", spy)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert st.lm_scores(docs).count() == docs.count()
    assert cost[1][0] > 100_000 and cost[1][1] < 4 * cost[1][0]     # a hash takes six
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("words_")]


def test_grams_are_told_by_part_context_and_word():
    word, context = (x.ravel() for x in np.meshgrid(np.arange(300), np.arange(40) * 7))
    for parts in (1, 7, 64):
        part = st.gram_parts(context, word, parts)
        assert part.min() >= 0 and part.max() < parts
        assert len(set(zip(part, context, word // parts))) == len(word)


def test_weights_go_to_blocks_that_need_them(spark):
    """Context 0 is a state, context 1 has no gram; block 1 only asks whether they are."""
    arrow = st._arrow(spark, st.ASKED)
    none, sums = np.zeros(2), np.array([[10.0, 0.0], [4.5, 0.0]])      # the count, its grams' less 0.5
    asked = pa.Table.from_batches([st.batch_of(
        arrow, [2], [0], [block], [st.packed(np.diff(key, prepend=0))],
        [st.packed(np.array([0.4, 0.0]) if block == 1 else none)],
        [st.packed(sums if block == 1 else np.zeros((2, 2)))],
        [st.packed(np.array([0.1, 0.0]) if block == 1 else none)])
        for block, key in ((1, np.array([0, 2])), (2, np.array([1, 3])))])
    rows = {r["block"]: st.unpacked(r["body"]) for r in
            st._answer(asked, st._arrow(spark, st.TABLE), 0.01).to_pylist()}
    assert rows[1].tolist() == [1, 0]
    assert rows[2].view(float).tolist() == pytest.approx([0.55 / 0.9, 0])
