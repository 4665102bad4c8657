"""Operator 10 against brute force; pruning, ties, edge cases."""

import math

import numpy as np

from clickwin.llm import topk


def brute(rows, ids, k=5):
    ok = {}
    cand = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints = [math.floor(256 * float(np.float32(x))) for x in v]
            cand.append((i, ints))
            ok.setdefault(i, (v, ints))
            if v < ok[i][0]:
                ok[i] = (v, ints)
    out = []
    for q in ids:
        if q in ok:
            score = sorted((-sum(a * b for a, b in zip(ok[q][1], v)), i) for i, v in cand if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(score[:k])]
    return sorted(out)


def run(spark, rows, ids, **kw):
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows],
                                  "vec_id long, embedding array<float>, rank int, score int")
    return sorted(tuple(r) for r in topk.top_k(table, table.where(table.vec_id.isin(ids)), **kw).collect())


def test_random_vectors_in_several_passes(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, 12)]) for i in range(900)]
    ids = list(range(0, 900, 50))
    want = brute(rows, ids)
    assert run(spark, rows, ids) == want
    assert run(spark, rows, ids, per_pass=5) == want


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [0.5, 0.25]) for i in range(700, 0, -1)]
    assert run(spark, rows, [50, 100]) == brute(rows, [50, 100])


def test_edge_cases(spark):
    rows = [(0, [0.1, 0.2]), (50, None), (100, [0.3, None]), (150, [float("nan"), 0.1]),
            (200, [float("inf"), 0.1]), (250, [0.3]), (300, []), (350, [0.1, -0.2, 0.7]),
            (None, [9.0, 9.0]), (1, [0.2, 0.2]), (1, [0.2, 0.2]), (0, [0.1, 0.2])]
    ids = [i for i, _ in rows if i is not None and i % 50 == 0]
    assert run(spark, rows, sorted(set(ids))) == brute(rows, sorted(set(ids)))
    assert run(spark, rows[:1], [0]) == []
    assert run(spark, rows[:0], [0]) == []


def test_blocks_below_the_kth_are_skipped():
    rng = np.random.default_rng(6)
    near = rng.normal(0, 1, (256, 8)) * 100
    far = rng.normal(0, 1, (256 * 9, 8))
    best = topk.Best(np.array([-1]), near[:1], 5)
    best.add(np.arange(256 * 10), np.vstack([near, far]))
    assert best.scored == 1
    want = np.argsort(-(np.vstack([near, far]) @ near[0]), kind="stable")[:5]
    assert best.found[0].tolist() == want.tolist()
