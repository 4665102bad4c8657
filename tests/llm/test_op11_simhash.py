"""Operator 11 against brute force: fingerprints, links, hot values, edge cases."""

import random

import pytest
import xxhash

from clickwin.llm import simhash as sh


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """``rows`` of (id, fingerprint): the smallest id reachable of each."""
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in rows:
        for j, b in rows:
            if i is not None and j is not None and (a ^ b).bit_count() <= 3:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def run(spark, rows, **kw):
    docs = spark.createDataFrame([(i, t, 1, "x", "k") for i, t in rows],
                                 "doc_id long, text string, fp int, label string, key string")
    return sorted((tuple(r) for r in sh.simhash(docs, **kw).collect()), key=repr)


def expected(rows):
    marks = [(i, brute_fingerprint(t)) for i, t in rows]
    least = brute_components(marks)
    return sorted(((i, f"{f:016x}", least.get(i)) for i, f in marks), key=repr)


def test_near_copies(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(15):
        base = [f"w{rng.randrange(900)}" for _ in range(rng.choice([1, 2, 3, 4, 40, 200, 500]))]
        for _ in range(rng.choice([1, 3, 9])):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = f"E{rng.randrange(99)}"
            rows.append((len(rows), rng.choice([" ", "\n\t"]).join(copy)))
    assert run(spark, rows) == expected(rows)


def test_edge_cases(spark):
    long_text = " ".join(f"a{i % 977}" for i in range(200_000))
    rows = [(5, None), (3, ""), (9, " \n\x0b"), (4, "One"), (2, "oNE"), (7, "one two"),
            (None, "one"), (None, None), (8, "one"), (8, "quite another text of six words"),
            (6, "quite another  text of six WORDS"), (10, long_text), (1, long_text + " end"),
            (11, "café 世界 one two"), (12, "café 世界 one two"),
            (13, None), (13, None)]
    assert run(spark, rows) == expected(rows)
    assert run(spark, []) == []


def fps_of(spark, values):
    return spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint")


def classes(values, pairs):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


@pytest.mark.parametrize("load", [1, 4, 64])
def test_hot_values_lose_no_link(spark, load):
    # a cloud around one value (dense, sparse and at distance 3 exactly), chains and noise
    rng = random.Random(load)
    centre, values = rng.getrandbits(64), set()
    for _ in range(150):
        v = centre
        for _ in range(rng.randrange(9)):
            v ^= 1 << rng.choice([rng.randrange(10), rng.randrange(64)])
        values.add(v)
    for _ in range(25):
        v = rng.getrandbits(64)
        values.add(v)
        values.add(v ^ sum(1 << b for b in rng.sample(range(64), 3)))
        values.add(v ^ sum(1 << b for b in rng.sample(range(64), 4)))
    values |= {0, (1 << 64) - 1, 7, 1 << 63}
    values = sorted(values)
    want = classes(values, [(a, b) for a in values for b in values
                            if 0 < (a ^ b).bit_count() <= 3])
    got = [(r.a % (1 << 64), r.b % (1 << 64))
           for r in sh.links(fps_of(spark, values), load).collect()]
    assert all(0 < (a ^ b).bit_count() <= 3 for a, b in got)
    assert classes(values, got) == want


def test_links_of_a_hot_value_are_linear(spark):
    # 600 fingerprints within few bits of one value: stars, not all pairs
    rng = random.Random(2)
    values = {sum(1 << b for b in rng.sample(range(12), rng.randrange(6))) for _ in range(3000)}
    pairs = sum((a ^ b).bit_count() <= 3 for a in values for b in values) // 2
    found = sh.links(fps_of(spark, sorted(values)), 8).distinct().count()
    assert found < 66 * len(values) and found < pairs


def test_registered_query_on_sf001(spark):
    from clickwin.llm.queries import LLM_QUERIES
    got = {r.doc_id: (r.fingerprint, r.component_id)
           for r in LLM_QUERIES["op11_simhash"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = expected([(r.doc_id, r.text) for r in docs])
    assert sorted(((i, f, c) for i, (f, c) in got.items()), key=repr) == want
