"""Operator 13 against brute force: filters, steps, Shapley values, edge cases."""

import random
import re
from fractions import Fraction
from itertools import permutations

import pytest

from clickwin.llm import filter_audit as fa


def fails(doc_id, text, rows):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return "".join(f for f, bad in (
        ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
        ("C", 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)),
        ("D", bool(re.search(r"[#$%&*|]", text))),
        ("E", doc_id is not None and any(i is not None and i < doc_id and (t or "") == text
                                         for i, _, t in rows))) if bad)


def brute(rows, labels):
    docs = [(part or "", fails(i, t or "", rows),
             any(a == i is not None and q == 1 for a, q, _ in labels),
             any(a == i is not None and x == 1 for a, _, x in labels)) for i, part, t in rows]
    out = []
    for part in {d[0] for d in docs}:
        mine, removed_by = [d for d in docs if d[0] == part], dict.fromkeys("ABCDE", 0)
        steps = []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                removed = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removed_by[f] += len(removed)
                steps.append((part, "".join(order), step, len(left), len(removed),
                              sum(f in d[1] for d in mine) - len(removed),
                              sum(d[1] == f for d in mine), sum(d[2] for d in removed),
                              sum(d[3] for d in removed), f))
        out += [(*s[:-1], removed_by[s[-1]]) for s in steps]
    return sorted(out)


def run(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, "x", True) for r in rows],
                                 "doc_id long, lang string, text string, mask int, part string, first boolean")
    marks = spark.createDataFrame([(*r, "x") for r in labels],
                                  "doc_id long, quality int, toxic int, text string")
    return sorted(tuple(r) for r in fa.filter_audit(docs, marks).collect())


def text_of(rng):
    n = rng.choice([0, 3, 199, 200, 230])
    words = [f"w{rng.randrange(rng.choice([40, 2000]))}" for _ in range(n)]
    if rng.random() < .3:
        words = [w.upper() for w in words]
    if words and rng.random() < .3:
        words[-1] += rng.choice("#$%&*|")
    return rng.choice([" ", "\n", "\t\x0b"]).join(words)


def test_against_brute_force(spark):
    rng = random.Random(4)
    texts = [text_of(rng) for _ in range(25)]
    rows = [(i, rng.choice(["en", "en", "de", None, ""]), rng.choice(texts)) for i in range(90)]
    labels = [(rng.randrange(100), rng.choice([0, 1, None]), rng.choice([0, 1, None]))
              for _ in range(80)]
    assert run(spark, rows, labels) == brute(rows, labels)


def test_edge_cases(spark):
    long_text = " ".join(f"word{i}" for i in range(200_000))
    exact = " ".join(["a", "b"] * 100)                  # 200 words, two distinct
    half = " ".join(f"x{i}" for i in range(100)) + " " + " ".join(["x0"] * 100)   # 50 percent: kept
    upper = "ABC" + "d" * 97                            # 3 percent exactly: kept by C
    rows = [(5, "en", None), (2, "en", ""), (2, "en", ""), (None, "en", ""), (None, None, None),
            (7, "de", long_text), (8, "fr", long_text), (1, "de", exact), (3, "de", half),
            (4, "de", upper), (6, "de", upper + "é"), (9, "de", "ÉÀ" * 50), (5, "en", "other")]
    labels = [(5, 1, 0), (5, 0, 1), (None, 1, 1), (8, None, 1), (99, 1, 1)]
    got = run(spark, rows, labels)
    assert got == brute(rows, labels)
    assert len(got) == 4 * 600
    assert run(spark, [], labels) == []
    assert run(spark, rows, []) == brute(rows, [])


@pytest.mark.parametrize("players", [1, 2, 3, 5])
def test_least_squares_give_shapley_values(players):
    rng = random.Random(players)
    values = [rng.randrange(10 ** 12) for _ in range(1 << players)]
    want = [Fraction(0)] * players
    orders = list(permutations(range(players)))
    for order in orders:
        before = 0
        for f in order:
            want[f] += Fraction(values[before | 1 << f] - values[before], len(orders))
            before |= 1 << f
    assert fa.shapley(values, players) == want


def test_hot_group_of_copies_is_joined_by_id(spark):
    # a third of the rows share one text: only the smallest id passes E
    rows = [(i, "en", "same" if i % 3 == 0 else f"own {i}") for i in range(300)]
    got = [r for r in run(spark, rows, []) if r[1] == "EABCD" and r[2] == 1]
    assert got == [("en", "EABCD", 1, 201, 99, 0, 0, 0, 0, got[0][-1])]
