"""Operator 12 against brute force: packing, counts, tiles, ranks, edge cases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickwin.llm import divergence as dv

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(rows, min_docs=10, top=10):
    rows = [tuple(x or "" for x in r) for r in rows]
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    groups = sorted({(lang, source) for lang, source, _ in rows})
    for lang, source, text in rows:
        found = terms(text)
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        mine = {s: {t: counts[lang, s][t] for t in kept} for a, s in groups if a == lang}
        whole = {t: sum(c[t] for c in mine.values()) for t in kept}

        def share(count):
            total = sum(count.values()) + 2 * len(kept)
            return {t: 1 + 10 ** 9 * (n + 2) // total for t, n in count.items()}

        q = share(whole)
        p = {s: share(c) for s, c in mine.items()}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in mine:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in mine if o != s]
            over = [(t, f(p[s][t], q[t])) for t in kept if mine[s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", over, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1)
                        for i, (item, value) in enumerate(items[:limit])]
    return sorted(out)


def run(spark, rows, **kw):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "lang string, source string, text string, term int, n string")
    return sorted(tuple(r) for r in dv.divergence(docs, **kw).collect())


ALPHABET = ["a", "bc", "Zyx", "word", "fivel", "é", "世界", "naïveté", "eightchr", "ninechars",
            "sixteencharacter", "seventeencharact", "seventeencharacte", "ÉCOLE" * 7, "x" * 64,
            "x" * 65, "x" * 63 + "y", "ab" * 8 + "c", "ab" * 8 + "d", "Straße", "—", "abcdefgh",
            "abcdefgi", "abcdefghi", "abcdefghj"]


def corpus(rng, n):
    rows = []
    for _ in range(n):
        k = rng.choice([0, 1, 3, 20, 60])
        text = "".join(rng.choice(ALPHABET) + rng.choice([" ", "\n", "1", "[", "\x00", "`{", "_"])
                       for _ in range(k))
        rows.append((rng.choice(["en", "en", "en", "de", "", None]),
                     rng.choice(["s1", "s1", "s2", "S3", "é", None]), text))
    return rows


def test_against_brute_force(spark):
    rows = corpus(random.Random(1), 300)
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, min_docs=40, top=3) == brute(rows, 40, 3)


def test_tiles_and_small_blocks(spark, monkeypatch):
    rows = corpus(random.Random(2), 200) + [("en", f"src{i}", "a word bc") for i in range(30)]
    monkeypatch.setattr(dv, "TILE", 4)
    monkeypatch.setattr(dv, "CELLS", 20)
    monkeypatch.setattr(dv, "BLOCK_BYTES", 500)
    assert run(spark, rows) == brute(rows)


def test_edge_cases(spark):
    huge = "z" * 300_000 + " " + "word " * 100_000
    rows = ([("en", "a", None), ("en", "b", ""), ("en", "c", "12 34"), (None, None, None)]
            + [("fr", "only", f"mot commun {i}") for i in range(12)]       # one source: no pair
            + [("xx", f"s{i % 3}", f"t{chr(97 + i)}") for i in range(9)]   # no kept term
            + [("en", "a", "word common"), ("en", "a", "word common")] * 6
            + [("en", "b", huge), ("en", "empty", " ")])
    got = run(spark, rows)
    assert got == brute(rows)
    assert ("xx", "s0", "pair", "s1", 0, 1) in got
    assert not [r for r in got if r[0] == "fr" and r[2] == "pair"]
    assert run(spark, []) == []


def test_shares_beyond_64_bits(spark):
    df = spark.sql("select 40000000000000 as n, 90000000000001 as total")
    assert df.select(dv._share("n", "total")).first()[0] == \
        1 + 10 ** 9 * (40000000000000 + 2) // 90000000000001


@pytest.mark.parametrize("seed", range(3))
def test_radix_order_is_stable(seed):
    rng = np.random.default_rng(seed)
    high = rng.integers(0, 50, 5000).astype(np.uint64) << np.uint64(40)
    low = rng.integers(0, 1 << 63, 50, np.uint64)[rng.integers(0, 50, 5000)]
    order = dv.radix_order([(low, 8), (high, 4)])
    assert order.tolist() == sorted(range(5000), key=lambda i: (int(high[i]), int(low[i]), i))


def test_counts_of_a_block():
    rng = random.Random(7)
    rows = sorted((rng.randrange(3), " ".join(rng.choices(ALPHABET, k=rng.randrange(30))))
                  for _ in range(40))
    parts = [t.encode() + b"\0" for _, t in rows]
    data = np.frombuffer(b"".join(parts), np.uint8)
    data, (g, start, length, n, docs) = dv.count_block(
        data, np.cumsum([len(p) for p in parts]), np.array([r[0] for r in rows]))
    got = {(int(a), data[s:s + k].tobytes().decode()): (int(c), int(d))
           for a, s, k, c, d in zip(g, start, length, n, docs)}
    want = {}
    for a, text in rows:
        for t, c in Counter(terms(text)).items():
            x, y = want.get((a, t), (0, 0))
            want[a, t] = x + c, y + 1
    assert got == want and len(g) == len(want)
