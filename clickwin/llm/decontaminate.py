"""Benchmark decontamination (operator 2).

Seeds are ``N`` consecutive words of a test item; training texts meet items
by them.  A seed counts for its rarity: the information of its words under
their frequencies in the whole corpus (copies of an item raise a few counts,
not by orders of magnitude, so a passage copied often stays rare).  Only
seeds of at least ``min_bits`` start an alignment alone, unless an item has
none; of the others ``FEW`` on nearby diagonals do, so that a passage whose
words are common because many texts hold it is aligned, too.
Around the seeds of one (text, item) pair a passage of the text is aligned
with the item by Smith-Waterman over words; the score is the best local
alignment's value over that of the whole item, so edits, insertions and
losses cost a little each.  A few common words are no copy of a short item: an
alignment must also be worth ``LEAST_WORDS`` matching words or the whole item.
Texts are read whole: every passage around a seed is aligned.
Items of one or two words have no such seed.  With ``every_item`` they match
a text that holds nothing else, and by their whole sequence where it stands
verbatim, if that is more than chance: its information must reach that of one
place of the corpus (log2 of its words), so neither "of the" nor a lone word
marks a longer text.  Items without an id take part, too.

The item list is broadcast while it stays below ``MAX_ITEM_BYTES`` of text
(checked); a longer list is worked through in slices below that size.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwin.llm.common import batch_of, merged

N = 3                       # words of a seed
MIN_BITS = 24.0             # information of a seed that starts an alignment
FEW = 2                     # common seeds that start an alignment together
THRESHOLD = 0.4             # of the item's full score
LEAST_WORDS = 6             # words an alignment is worth at least (or the whole item)
MATCH, MISMATCH, GAP = 2, -1, -1
MAX_ITEM_BYTES = 32 << 20
# scripts without spaces (kana, Han, Thai, Lao, Burmese, Khmer): a character is a word
NO_SPACES = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(rf"[^\W{NO_SPACES}]+|(?=\w)[{NO_SPACES}]")


def tokens(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class Items:
    """Test items as word numbers (1 ...; 0 is any other word) and their seeds."""

    def __init__(self, rows: list[tuple]):
        self.ids = [i for i, _ in rows]
        self.number: dict[str, int] = {}
        self.seqs = [np.array([self.number.setdefault(w, len(self.number) + 1)
                               for w in tokens(t)], np.int64) for _, t in rows]
        keys, item, off = [], [], []
        for k, seq in enumerate(self.seqs):
            n = min(N, len(seq))
            grams = self.grams(seq) if n == N else np.zeros(0, np.uint64)
            keys.append(grams)
            item.append(np.full(len(grams), k))
            off.append(np.arange(len(grams)))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.item = (np.concatenate(item) if item else np.zeros(0, int))[order]
        self.off = (np.concatenate(off) if off else np.zeros(0, int))[order]
        self.good = np.ones(len(self.keys), bool)
        self.short: dict[tuple, list[tuple]] = {}    # items matched by their whole sequence

    def state(self) -> dict:
        """Plain values to broadcast: workers need not know this class by name."""
        return dict(self.__dict__)

    @classmethod
    def of(cls, state: dict) -> Items:
        items = cls.__new__(cls)
        items.__dict__.update(state)
        return items

    def encode(self, words: list[str]) -> np.ndarray:
        get = self.number.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    @staticmethod
    def grams(seq: np.ndarray) -> np.ndarray:
        """Keys of N word numbers (21 bits each); 0 where a word is unknown.  With
        more words than that, grams may share a key; the alignment tells them apart."""
        parts = [seq[i:len(seq) - N + 1 + i] for i in range(N)]
        key = np.zeros(len(parts[0]), np.uint64)
        for p in parts:
            key = (key << np.uint64(21)) | p.astype(np.uint64)
        key[reduce(np.logical_or, [p == 0 for p in parts])] = 0
        return key

    def weigh(self, counts: np.ndarray, total: int, min_bits: float,
              every_item: bool = False) -> None:
        """Keep the seeds with enough information; an item without any keeps all."""
        bits = -np.log2((counts + 1) / (total + len(counts) + 1))
        value = np.zeros(len(self.keys))
        for i, (k, o) in enumerate(zip(self.item, self.off)):
            value[i] = bits[self.seqs[k][o:o + N]].sum()
        self.good = value >= min_bits
        some = np.zeros(len(self.ids), bool)
        some[self.item[self.good]] = True
        self.good |= ~some[self.item]
        self.short = {}
        for k, seq in enumerate(self.seqs if every_item else ()):
            if 0 < len(seq) < N:
                rare = bool(bits[seq].sum() >= np.log2(total + 1))
                self.short.setdefault(tuple(seq.tolist()), []).append((k, rare))

    def passages(self, seq: np.ndarray) -> dict[int, list[list[int]]]:
        """Merged stretches of a text around the seeds of each item."""
        out: dict[int, list[list[int]]] = {}
        self._verbatim(out, seq)
        if len(seq) < N or not len(self.keys):
            return out
        grams = self.grams(seq)
        lo = np.searchsorted(self.keys, grams, "left")
        hi = np.searchsorted(self.keys, grams, "right")
        common: dict[int, list[tuple[int, int]]] = {}
        for at in np.flatnonzero((hi > lo) & (grams > 0)):
            for j in range(lo[at], hi[at]):
                k, off = int(self.item[j]), self.off[j]
                if self.good[j]:
                    self._around(out, k, at - off, len(seq))
                else:
                    common.setdefault(k, []).append((at - off, off))
        for k, hits in common.items():
            slack, together = self._slack(k), {}
            for diagonal, off in hits:          # nearby: in one strip or the next
                for strip in (diagonal // slack, diagonal // slack + 1):
                    together.setdefault(strip, set()).add(off)
            for diagonal, _ in hits:
                strip = diagonal // slack
                if max(len(together[strip]), len(together[strip + 1])) >= FEW:
                    self._around(out, k, diagonal, len(seq))
        return {k: merged(mine) for k, mine in out.items()}

    def _verbatim(self, out: dict, seq: np.ndarray) -> None:
        """Adds the places of short items."""
        if not self.short:
            return
        first = np.unique([s[0] for s in self.short])
        for at in np.flatnonzero(np.isin(seq, first)).tolist():
            for n in range(1, min(N, len(seq) - at + 1)):
                for k, rare in self.short.get(tuple(seq[at:at + n].tolist()), ()):
                    if rare or n == len(seq):
                        out.setdefault(k, []).append([at, at + n])

    def _slack(self, k: int) -> int:
        return len(self.seqs[k]) // 2 + N

    def _around(self, out: dict, k: int, diagonal: int, end: int) -> None:
        """Adds the stretch of a text that item ``k`` may take on a diagonal."""
        a = max(0, diagonal - self._slack(k))
        b = min(end, diagonal + len(self.seqs[k]) + self._slack(k))
        mine = out.setdefault(k, [])
        if mine and mine[-1][0] <= a <= mine[-1][1]:
            mine[-1][1] = max(mine[-1][1], b)
        else:
            mine.append([a, b])


def smith_waterman(text: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """(value, end position in the text) of the best local alignment.

    Row by row over the text; the gap along the item is a running maximum, so
    a row is a few array operations.
    """
    m = len(item)
    steps = np.arange(1, m + 1) * -GAP
    last, best, end = np.zeros(m + 1, np.int64), 0, 0
    for i, w in enumerate(text):
        hit = np.where(item == w, MATCH, MISMATCH) if w else MISMATCH
        row = np.maximum(np.maximum(last[:-1] + hit, last[1:] + GAP), 0)
        row = np.maximum.accumulate(row + steps) - steps
        last = np.concatenate([[0], row])
        if (top := row.max()) > best:
            best, end = int(top), i + 1
    return best, end


def _slices(benchmark: DataFrame, every_item: bool):
    """The items in lists of at most MAX_ITEM_BYTES of text (one at least)."""
    rows = benchmark.select("item_id", "text")
    if not every_item:
        rows = rows.where("item_id is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = max(1, -(-size // (MAX_ITEM_BYTES // 2)))
    for p in range(number):
        part = rows if number == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == p)
        got = sorted({(r["item_id"], r["text"]) for r in part.collect()},
                     key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1] or ""))
        if got:
            yield Items(got)


def word_counts(docs: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """Corpus counts of the items' words (number 0: all others), and all words."""
    shared = docs.sparkSession.sparkContext.broadcast(items.state())
    arrow = pa.schema([("word", pa.int64()), ("n", pa.int64())])

    def run(batches):
        items = Items.of(shared.value)
        n = np.zeros(len(items.number) + 1, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                n += np.bincount(items.encode(tokens(text)), minlength=len(n))
        at = np.flatnonzero(n)
        yield batch_of(arrow, at, n[at])

    got = (docs.select("text").mapInArrow(run, "word bigint, n bigint")
           .groupBy("word").agg(F.sum("n").alias("n")).collect())    # words of the items + 1
    counts = np.zeros(len(items.number) + 1, np.int64)
    for r in got:
        counts[r["word"]] = r["n"]
    return counts, int(counts.sum())


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                 min_bits: float = MIN_BITS, every_item: bool = False) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word`` of every pair whose
    best alignment reaches ``threshold``; the span is the aligned passage
    (words from 0).

    A null or empty text or item matches nothing.  Items of fewer than N words
    and items with a null id (given as null) match only with ``every_item``.
    Repeated documents give repeated rows, repeated items one.
    Other columns are not read; empty tables give no rows.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, item_id {item_type}, score double, first_word bigint, "
              "last_word bigint")
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)
    found = [spark.createDataFrame([], schema)]
    for items in _slices(benchmark, every_item):
        items.weigh(*word_counts(docs, items), min_bits, every_item)
        found.append(_scan(docs, items, threshold, schema, arrow))
    return reduce(DataFrame.unionByName, found)


def leaks(items: Items, text: str | None, threshold: float):
    """(item, score, first word, last word) of every item the text holds."""
    seq = items.encode(tokens(text))
    for k, spans in items.passages(seq).items():
        item = items.seqs[k]
        full = MATCH * len(item)
        need = max(threshold * full, min(full, MATCH * LEAST_WORDS))
        best = (0, 0, 0)
        for a, b in spans:
            # words that no side shares cannot raise the value enough
            if MATCH * np.isin(item, seq[a:b]).sum() < need:
                continue
            value, end = smith_waterman(seq[a:b], item)
            if value > best[0]:
                _, back = smith_waterman(seq[a:a + end][::-1], item[::-1])
                best = (value, a + end - back, a + end - 1)
        if best[0] >= need > 0:
            yield k, best[0] / full, best[1], best[2]


def _scan(docs, items, threshold, schema, arrow) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items.state())

    def run(batches):
        items = Items.of(shared.value)
        for batch in batches:
            rows = [(doc, items.ids[k], *rest)
                    for doc, text in zip(batch.column("doc_id").to_pylist(),
                                         batch.column("text").to_pylist())
                    for k, *rest in leaks(items, text, threshold)]
            yield batch_of(arrow, *(map(list, zip(*rows)) if rows else [[]] * 5))

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                  min_bits: float = MIN_BITS, every_item: bool = False) -> DataFrame:
    """``docs`` without the rows whose text holds a test item's passage.

    Rows are judged one by one where they are, so nothing is shuffled and rows
    with null or repeated ids are kept or dropped by their own text.
    """
    left = docs
    for items in _slices(benchmark, every_item):
        items.weigh(*word_counts(docs, items), min_bits, every_item)
        left = _without(left, items, threshold)
    return left


def _without(docs: DataFrame, items: Items, threshold: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items.state())

    def run(batches):
        items = Items.of(shared.value)
        for batch in batches:
            clean = [next(leaks(items, text, threshold), None) is None
                     for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
