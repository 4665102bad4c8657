"""Operator 7: targets, quotas, draws, edge cases."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from clickwin.llm.mixing import mix, plan_mix, splitting_tree, targets


def brute_targets(sizes, cap=3.0):
    """Share by weight; stop at the cap; share the excess again."""
    w = [i % 3 + 1 for i in range(len(sizes))]
    fixed, out = set(), [0.0] * len(sizes)
    while True:
        left = sum(sizes) - sum(cap * sizes[i] for i in fixed)
        load = sum(w[i] for i in range(len(sizes)) if i not in fixed)
        out = [cap * sizes[i] if i in fixed else left * w[i] / load for i in range(len(sizes))]
        over = {i for i in range(len(sizes)) if i not in fixed and out[i] > cap * sizes[i] + 1e-9}
        if not over:
            return out
        fixed |= over


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 5, 7, 0, 30], [0, 0], [5], [3, 1, 1, 900, 2, 40]])
def test_targets_equal_repeated_sharing(sizes):
    got = targets([(str(i), n) for i, n in enumerate(sizes)])
    assert got == pytest.approx(brute_targets(sizes))
    assert sum(got) == pytest.approx(sum(sizes))


def test_tree_keeps_quotas_and_balances():
    quotas = np.array([1000, 3, 0, 77, 1_000_000])
    out = splitting_tree(quotas, 16, np.random.default_rng(1))
    assert (out.sum(0) == quotas).all() and (out >= 0).all()
    assert out.sum(1).max() - out.sum(1).min() <= 4
    share = out[:, 0] / out[:, 0].sum()
    assert share.max() < 0.5 or quotas[0] < 100
    assert (splitting_tree(np.array([0, 0]), 3, np.random.default_rng(1)) == 0).all()


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string, size string, mix_copy int, key__ int")


def test_draws_come_near_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = plan_mix(docs.select("doc_id", "source", "text")).collect()
    assert len(rows) == docs.count()
    taken, most = Counter(), Counter()
    info = {}
    for r in rows:
        assert len(r.places) <= 3 and r.size == len((r.text or "").encode().split())
        taken[r.source] += r.size * len(r.places)
        most[r.source] = max(most[r.source], r.size)
        info[r.source] = (r.source_size, r.target)
    for s, (size, target) in info.items():
        assert abs(taken[s] - target) <= most[s] and target <= 3 * size + 1e-6


def test_mix_repeats_rows_as_planned_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    copies = {r.doc_id: len(r.places) for r in plan_mix(docs).select("doc_id", "places").collect()}
    a = [tuple(r) for r in mix(docs).select("doc_id", "mix_shard", "mix_copy").collect()]
    assert Counter(d for d, *_ in a) == Counter({d: n for d, n in copies.items() if n})
    assert sorted(a) == sorted(tuple(r) for r in mix(docs).select("doc_id", "mix_shard", "mix_copy").collect())
    assert mix(docs).columns == docs.columns + ["mix_shard", "mix_copy"]
    shards = defaultdict(list)
    for d, s, _ in a:
        shards[s].append(d)
    assert all(v != sorted(v) for v in shards.values() if len(v) > 12)


def test_edge_cases(spark):
    rows = [(1, "b", None, "x", 1, 1), (2, "b", "", "x", 1, 1), (3, None, "one two", "x", 1, 1),
            (3, None, "one two", "x", 1, 1), (None, "a", "w " * 50_000, "x", 1, 1),
            (5, "ä", "three words here", "x", 1, 1), (6, "null", "a", "x", 1, 1)]
    got = plan_mix(docs_of(spark, rows)).collect()
    assert len(got) == len(rows) and {r.size for r in got} == {0, 2, 50_000, 3, 1}
    by = {r.source: r for r in got}
    assert by[None].source_size == 4 and by["b"].source_size == 0 and by["b"].target == 0
    out = mix(docs_of(spark, rows))
    assert out.columns == ["doc_id", "source", "text", "size", "key__", "mix_shard", "mix_copy"]
    assert all(r.size == "x" and r.key__ == 1 for r in out.collect())
    empty = docs_of(spark, rows).limit(0)
    assert plan_mix(empty).count() == 0 and mix(empty).count() == 0
