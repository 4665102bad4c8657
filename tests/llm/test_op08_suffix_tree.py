"""Operator 8: base score and tree score against brute force, edge cases."""

import math
import zlib
from collections import Counter

import pytest

from clickwin.llm import suffix_tree as st

CFG = st.Settings(min_share=(0.02, 0.01), min_next=0.01, discount=0.5, divergence=0.02)


def seq(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w] + [""]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


class Brute:
    """The tree by its definition."""

    def __init__(self, rows, cfg):
        train = [seq(t) for i, t in rows if not held(i)]
        self.c = Counter(w for s in train for w in s)
        self.n, self.v, self.cfg = sum(self.c.values()), len(self.c), cfg
        self.states = {}
        level = [(w,) for w, k in self.c.items() if w and k >= cfg.min_share[0] * self.n]
        heads = set(level)
        for depth in (1, 2):
            nxt = {}
            for s in train:
                for i in range(len(s) - depth):
                    ctx = tuple(s[i:i + depth])
                    if ctx in set(level):
                        nxt.setdefault(ctx, Counter())[s[i + depth]] += 1
            kept = {}
            for ctx, cnt in nxt.items():
                total = sum(cnt.values())
                kept[ctx] = {w: k for w, k in cnt.items() if k >= max(2, cfg.min_next * total)}
                if not kept[ctx]:
                    continue
                p = {w: (k - cfg.discount) / total for w, k in kept[ctx].items()}
                low = {w: self.prob(ctx[1:], w) for w in p}
                rest, room = 1 - sum(p.values()), max(1 - sum(low.values()), 1e-12)
                kl = sum(p[w] * math.log(p[w] / low[w]) for w in p) + rest * math.log(
                    max(rest, 1e-300) / room)
                if kl >= cfg.divergence:
                    self.states[ctx] = (p, rest / room)
            if depth == 1:
                level = [(*c, w) for c, ws in kept.items() for w, k in ws.items()
                         if k >= cfg.min_share[1] * self.n and (w,) in heads]

    def prob(self, ctx, w):
        while ctx and ctx not in self.states:
            ctx = ctx[1:]
        if not ctx:
            return (self.c[w] + 0.1) / (self.n + 0.1 * (self.v + 1))
        p, back = self.states[ctx]
        return p[w] if w in p else back * self.prob(ctx[1:], w)

    def rows(self, rows):
        out = []
        for i, t in rows:
            s = seq(t)
            out.append((i, held(i), len(s), sum(self.c[w] > 0 for w in s), self.n,
                        sum(math.log10((self.c[w] + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in s),
                        sum(math.log10(self.prob(tuple(s[max(0, k - 2):k]), w)) for k, w in enumerate(s))))
        return out


def compare(spark, rows, cfg, monkeypatch=None):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows],
                                 "doc_id long, text string, score int, word string")
    got = sorted((tuple(r) for r in st.lm_scores(docs, cfg).collect()), key=repr)
    model = Brute(rows, cfg)
    want = sorted(model.rows(rows), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)
    return model


def test_scores_equal_brute_force_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    model = compare(spark, rows, st.Settings(min_share=(0.004, 0.0005)))
    assert model.states


def test_long_contexts_are_found_and_used(spark):
    rows = [(i, "the cat sat on the mat The dog sat on the rug " * 5 + f"w{i}") for i in range(30)]
    model = compare(spark, rows, CFG)
    assert {len(c) for c in model.states} == {1, 2}
    for ctx, (p, back) in model.states.items():     # a distribution: sums to one
        words = set(model.c)
        total = sum(model.prob(ctx, w) for w in words)
        unseen = model.prob(ctx, "never seen")
        assert total + unseen == pytest.approx(1, abs=1e-9)


def test_several_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(st, "BLOCK_BYTES", 300)
    monkeypatch.setattr(st, "SLICE", 7)
    rows = [(i, "a b a c the a b " * (i % 5) + f"x{i % 7}") for i in range(40)]
    compare(spark, rows, CFG)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b a b"), (5, "a b a b"), (5, "a b a b"),
            (6, "A\x0bB\x1fc É é"), (7, "long " * 100_000)]
    compare(spark, rows, CFG)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert st.lm_scores(docs).count() == 0


def test_only_held_out_rows(spark):
    i = next(k for k in range(1000) if held(k))
    out = st.lm_scores(spark.createDataFrame([(i, "a b")], "doc_id long, text string")).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out] == [(3, 0, 0, 0, 0)]


def test_better_than_unigrams_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in st.lm_scores(docs).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
