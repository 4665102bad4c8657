"""Filter interaction audit (operator 13).

A document's failures are a mask of one bit per filter.  Documents are counted
by part and mask, and the counts tabulated for all 32 coalitions of filters:
what a coalition removes is what fails any of its filters.  Two entries of
that table tell a step of any order: a filter removes what its predecessors
and it remove together, less what its predecessors remove.

A filter's Shapley value is the solution of the constrained least squares
problem over coalitions S: weigh (v(S) - sum of the values of S's filters)
squared by the Shapley kernel, and let all values sum to what all filters
remove.  Its normal equations are solved in rationals, so the sum over all
orders (120 times the value) is exact.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwin.session import materialize

FILTERS = "ABCDE"
SIZE = len(FILTERS)
ALL = (1 << SIZE) - 1
WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 200
MIN_DISTINCT = 50           # percent of the words
MAX_UPPER = 3               # percent of the code points
SYMBOLS = "[#$%&*|]"


def text_mask(text: str, words: str) -> Column:
    """Bits of the filters A to D that a text with these words fails."""
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < MIN_WORDS, 100 * distinct < MIN_DISTINCT * n,
             100 * upper.cast("bigint") > MAX_UPPER * F.length(text).cast("bigint"),
             F.col(text).rlike(SYMBOLS)]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic`` per document.

    Equal texts are found by their SHA-256.  A group of copies gives one row
    per task before it is exchanged, and is joined by its smallest id, so that
    no group meets in one task.
    """
    texts = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"),
                        F.coalesce("text", F.lit("")).alias("text"))
    rows = materialize(
        texts.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
        .select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256))
                .alias("digest"), text_mask("text", "words").alias("mask")), "filter-masks")
    first = (rows.where("doc_id is not null").groupBy("digest")
             .agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True)))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        *[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(to)
          for c, to in (("quality", "good"), ("toxic", "toxic"))])
    named = (rows.where("doc_id is not null").join(first, ["doc_id", "digest"], "left")
             .join(marks, "doc_id", "left")
             .select("part", F.when(F.col("first"), F.col("mask"))
                     .otherwise(F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"),
                     *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]))
    # a row without an id has no smaller one and no label
    return named.unionByName(rows.where("doc_id is null").select(
        "part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic")))


def coalitions(fails: DataFrame) -> DataFrame:
    """``part, total, removed, good, toxic``: what each of the 32 coalitions
    removes, as arrays by the coalition's bits."""
    masks = fails.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"),
        F.count_if("toxic").alias("toxic"))
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    table = (masks.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(ALL))))
             .groupBy("part", "coalition").agg(
                 F.sum("n").alias("total"),
                 *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c)
                   for c in ("n", "good", "toxic")]))
    cell = F.struct("coalition", "n", "good", "toxic")
    return (table.groupBy("part").agg(F.max("total").alias("total"),
                                      F.array_sort(F.collect_list(cell)).alias("cells"))
            .select("part", "total", F.col("cells.n").alias("removed"), F.col("cells.good"),
                    F.col("cells.toxic")))


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of a regular system, by elimination in rationals."""
    rows = [list(r) + [b] for r, b in zip(matrix, right)]
    for i in range(len(rows)):
        pivot = next(k for k in range(i, len(rows)) if rows[k][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(len(rows)):
            if k != i and rows[k][i]:
                rows[k] = [x - rows[k][i] * y for x, y in zip(rows[k], rows[i])]
    return [r[-1] for r in rows]


def shapley(values: list[int], players: int = SIZE) -> list[Fraction]:
    """Shapley values of the coalition values (by bits), as the minimum of the
    kernel-weighted squares under the efficiency constraint: normal equations
    bordered by the constraint's multiplier."""
    whole = (1 << players) - 1
    gain = [v - values[0] for v in values]
    if players == 1:
        return [Fraction(gain[1])]
    matrix = [[Fraction(0)] * (players + 1) for _ in range(players + 1)]
    right = [Fraction(0)] * players + [Fraction(gain[whole])]
    for s in range(1, whole):
        size = s.bit_count()
        weight = Fraction(players - 1, comb(players, size) * size * (players - size))
        inside = [i for i in range(players) if s >> i & 1]
        for i in inside:
            right[i] += weight * gain[s]
            for j in inside:
                matrix[i][j] += weight
    for i in range(players):
        matrix[i][players] = matrix[players][i] = Fraction(1)
    return solve(matrix, right)[:players]


AUDIT = ("part string, filter_order string, step int, kept bigint, removed bigint, "
         "redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, "
         "shapley bigint")


def orders(table: DataFrame) -> DataFrame:
    """Every step of every order of the filters, from a coalition table."""
    def run(frames):
        import pandas as pd
        for pdf in frames:
            out = []
            for part, total, v, good, toxic in pdf.itertuples(index=False):
                v, good, toxic = ([int(x) for x in c] for c in (v, good, toxic))
                sums = [int(factorial(SIZE) * x) for x in shapley(v)]
                for order in permutations(range(SIZE)):
                    before = 0
                    for step, f in enumerate(order, 1):
                        bit = 1 << f
                        after = before | bit
                        gone = v[after] - v[before]
                        out.append((part, "".join(FILTERS[i] for i in order), step,
                                    int(total) - v[after], gone, v[bit] - gone,
                                    v[ALL] - v[ALL & ~bit], good[after] - good[before],
                                    toxic[after] - toxic[before], sums[f]))
                        before = after
            yield pd.DataFrame(out, columns=[c.split()[0] for c in AUDIT.split(", ")])

    return table.mapInPandas(run, AUDIT)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter does at each step of all 120 orders, per language.

    ``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley``; the step's filter is that letter of
    ``filter_order`` and ``shapley`` its removals summed over all orders.
    Counts are of rows.  A null text is empty, a null language the part ''.
    A text equal to that of a smaller id fails E; rows of the smallest id
    itself (repeated ones too) and rows without an id do not.  A document is
    good (toxic) if any of its label rows says so; a null label says nothing.
    Other columns are not read; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "lang", "text")
    return orders(coalitions(failures(docs, labels.select("doc_id", "quality", "toxic"))))
