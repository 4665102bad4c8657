"""LM scoring with a probabilistic suffix tree (operator 8).

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` (A-Z lowered) and one end.  The
root is the unigram distribution smoothed by 0.1.  Contexts of one to ``depth``
words seen at least ``min_count`` times in the training texts are candidate
states; a state keeps the next words seen at least twice, discounted by
``discount``, and leaves the rest of its mass to its suffix's distribution (so
every state's probabilities sum to one).  A context stays in the tree only if
its distribution differs from its suffix's by at least ``divergence`` nats
(Kullback-Leibler).  A token is scored by the longest suffix of what stands
before it that is a state.

The corpus is tokenised once into blocks (one row each: token numbers and the
parts of the words) and stored in buckets by block, so that no later pass
exchanges it; the words themselves are dropped once counted.
The tree grows with the corpus and is held as a table: counts of words, counts
of grams (a context and its next word) and back-off weights of states, each
for the blocks that need them.  A block asks for its own distinct words, grams
and contexts: they are dealt to parts and sent as one packed row per part.
Words and contexts that count are numbered by the answers, so a gram is asked
for by two small numbers, not by a hash, and is told exactly.  The rows of a
part are summed in one group and answered in the same order without the keys,
so an answer costs a few bits where a gram is seen once; a back-off weight is
only sent to blocks where a token needs it.  There are as many parts as blocks:
a group holds about as many keys as a block, and of a frequent one as many as
there are blocks.  Levels are built one by one: a context is only extended
where its count, known from the level below, allows it.  Nothing of the tree
reaches the driver.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwin.llm.common import batch_of, blocks, utf8, words
from clickwin.session import scratch_path

ALPHA = 0.1
BLOCK_BYTES = 8 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BUCKETS = 50_000           # of the stored corpus at most (a bucket holds many blocks)
SLICE = 1 << 18            # tokens summed at a time
END = b""                   # the end symbol; no word is empty


@dataclass(frozen=True)
class Settings:
    min_count: int = 10                     # of contexts
    depth: int = 3                          # words of the longest context
    min_share: tuple | None = None          # of contexts of one, two, ... words, for min_count and depth
    min_next: float = 0.0
    discount: float = 0.5
    divergence: float = 0.01

    @property
    def levels(self) -> int:
        return self.depth if self.min_share is None else len(self.min_share)

    def least(self, length: int, n: int) -> float:
        """Count of a candidate context of ``length`` words (what is seen once
        has no next word seen twice)."""
        return max(2, self.min_count if self.min_share is None else self.min_share[length - 1] * n)

    def numbered(self, kind: int) -> float:
        """Count from which grams of a kind may be contexts and get numbers."""
        if kind >= 2 * self.levels - 1:
            return np.inf
        return max(2, self.min_count if self.min_share is None else 2)


def held_out(id_col: str):
    """True where crc32 of the id as text is 0 modulo 10 (null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 10 == 0, F.lit(False))


def word_parts(vocab, parts: int) -> np.ndarray:
    """Parts of words by their hash."""
    u = np.fromiter(map(xxhash.xxh64_intdigest, vocab), np.uint64, len(vocab))
    return (((u >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def expanded(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def packed(x: np.ndarray) -> bytes:
    """Numbers of eight bytes, first all their first bytes, then all their
    second ones, ...: bytes that are mostly equal compress away."""
    return squeezed(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(data: bytes, dtype=np.int64) -> np.ndarray:
    planes = np.frombuffer(expanded(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def dealt(part: np.ndarray, parts: int) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """The order by parts, equal ones as they stand, and the stretch of every part in it."""
    order = np.argsort(part.astype(np.uint16 if parts <= 1 << 16 else np.int64), kind="stable")
    stops = np.cumsum(np.bincount(part)).tolist() if len(part) else []
    return order, [(p, slice(a, b)) for p, (a, b) in enumerate(zip([0, *stops], stops)) if a < b]


def distinct(x: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The first place of every distinct value, by value, and each place's
    number among them.  Values from 0 to ``most`` are sorted with their places
    in one number where both fit, several times faster than places by value."""
    bits = max(1, len(x).bit_length())
    packs = most is not None and most.bit_length() + bits < 64
    if packs:
        y = np.sort((x << bits) | np.arange(len(x)))
        order = y & ((1 << bits) - 1)
        y >>= bits
    else:
        order = np.argsort(x)
        y = x[order]
    new = np.ones(len(y), bool)
    new[1:] = y[1:] != y[:-1]
    which = np.empty(len(y), np.int64)
    which[order] = np.cumsum(new) - 1
    if packs:               # equal values stand by place
        return order[new], which
    return np.minimum.reduceat(order, np.flatnonzero(new)) if len(y) else order, which


def tokenise(docs: DataFrame, parts: int) -> DataFrame:
    """Blocks of documents: ``block, ids, held, ends, tokens, deal, vocab, trained, n``.

    ``tokens`` are numbers into ``vocab`` (number 0 is the end; its words are
    joined by spaces), ``deal`` each word's part, ``ends`` the documents' ends in ``tokens``, ``trained``
    each word's training count, ``n`` their sum.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"block bigint, ids array<{id_type}>, held array<boolean>, ends binary, "
              "tokens binary, deal binary, vocab binary, trained binary, n bigint")
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)

    def run(batches):
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        at = 0
        for part in blocks(batches, "text", BLOCK_BYTES):
            number = defaultdict(count().__next__)
            number[END]
            held = np.array(part.column("held").to_pylist(), bool)
            seqs = []
            for text in utf8(part, "text"):
                w = words(text)
                w.append(END)
                seqs.append(np.fromiter(map(number.__getitem__, w), np.int64, len(w)))
            ends = np.cumsum([len(s) for s in seqs])
            learn = [s for s, h in zip(seqs, held) if not h]
            trained = np.bincount(np.concatenate(learn) if learn else np.zeros(0, np.int64),
                                  minlength=len(number)).astype(np.int64)
            yield batch_of(arrow, [(task << 32) + at], pa.array([part.column("doc_id").to_pylist()],
                                                             arrow.field("ids").type),
                           [held], [packed(ends.astype(np.int64))], [packed(np.concatenate(seqs))],
                           [packed(word_parts(number, parts))],
                           [squeezed(b" ".join(number))], [packed(trained)], [int(trained.sum())])
            at += 1

    return (docs.select("doc_id", "text", held_out("doc_id").alias("held"))
            .mapInArrow(run, schema))


def stored(table: DataFrame, name: str, parts: int) -> DataFrame:
    """``table`` added to a stored one in buckets by block, which is returned:
    two such tables meet by block without an exchange.  Shuffle files of a
    finished write are not needed again and are deleted at once."""
    spark = table.sparkSession
    write = table.write.bucketBy(min(parts, BUCKETS), "block").mode("append")
    if not spark.catalog.tableExists(name):
        write = write.option("path", scratch_path(spark, name))
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        write.saveAsTable(name)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.table(name)


def places(number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What has a number (not -1), in their order, and each one's place in it."""
    by = np.flatnonzero(number >= 0)
    by = by[np.argsort(number[by])]
    place = np.full(len(number), -1, np.int64)
    place[by] = np.arange(len(by))
    return by, place


def gram_parts(context: np.ndarray, word: np.ndarray, parts: int) -> np.ndarray:
    """Parts of grams: a context's next words go to parts of their own, so part,
    context and the word's number without its part tell the gram."""
    x = (context.view(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    return (word + (x * np.uint64(parts) >> np.uint64(32)).astype(np.int64)) % parts


# Kinds of rows of the tree's table: words are 0, grams of contexts of d words
# 2 d - 1, states of d words 2 d.  ``body`` answers the keys that a block sent
# to a part, in their order: counts; counts times two, plus one where the gram
# is the block's to sum; back-off weights, or 1 where the block only needs to
# know that there is one, all next words being the state's.  0 is "none", rows of none are left out.
# ``code`` numbers, within the part, the words seen twice (frequent ones first)
# and the grams that may be contexts (in their order, as differences): a number
# times the parts plus the part is the word's or gram's in the corpus.  Grams
# are asked for by the numbers of their contexts (key) and words (b), states by
# numbers times two, plus one where the weight is needed, with sums over their
# grams: a, the counts of the states and of the grams in b, and e.
TABLE = "block bigint, kind int, part bigint, body binary, fresh bigint, code binary"
ASKED = "kind int, part bigint, block bigint, key binary, a binary, b binary, e binary"


def _arrow(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def _answer(asked: pa.Table, arrow: pa.Schema, divergence: float, numbered: float = np.inf) -> pa.Table:
    """The rows of the table for all that was asked of one kind in one part;
    grams seen ``numbered`` times get numbers."""
    asked = asked.sort_by("block")
    kind, part = asked.column("kind")[0].as_py(), asked.column("part")[0].as_py()
    keys = asked.column("key").to_pylist()
    a, b, e = ([unpacked(x, np.int64 if kind == 0 or kind % 2 else float) for x in
                asked.column(c).to_pylist() if x is not None] for c in "abe")
    sizes, fresh, code = [len(x) for x in a], 0, None
    if kind == 0:
        same = pa.array(b" ".join(map(expanded, keys)).split(b" "), pa.large_binary()).dictionary_encode()
        which = same.indices.to_numpy()
        total = np.bincount(which, np.concatenate(a)).astype(np.int64)
        fresh = int((total > 0).sum())
        value = total[which]
        rank = np.empty(len(total), np.int64)
        rank[np.argsort(-total, kind="stable")] = np.arange(len(total))
        code = np.where(total < 2, -1, rank)[which]
    else:
        key = np.concatenate([np.cumsum(unpacked(k, np.uint64), dtype=np.uint64) for k in keys])
        most = None
        if kind and kind % 2 == 0:
            key, wanted = key >> np.uint64(1), (key & np.uint64(1)).astype(bool)
            most = int(key.max(initial=0))
            key = key.astype(np.int64)
        elif b:
            word = np.concatenate(b)
            radix = int(word.max(initial=0)) + 1
            most = (int(key.max(initial=0)) + 1) * radix
            if most >= 1 << 63:
                key = distinct(key)[1]
                most = (int(key.max()) + 1) * radix
            key = key.astype(np.int64) * radix + word
        first, which = distinct(key, most)
        if kind % 2:            # the first block that has it sums a gram: sums lie in few blocks
            total = np.bincount(which, np.concatenate(a)).astype(np.int64)
            value = 2 * total[which]
            value[first] += 1
            value[total[which] < 2] = 0
            code = np.where(total < numbered, -1, np.cumsum(total >= numbered) - 1)[which]
        else:
            seen, b = np.concatenate([x.reshape(2, -1) for x in b], axis=1)
            a, b, e = (np.bincount(which, x) for x in (np.concatenate(a), b, np.concatenate(e)))
            total = np.ones(len(b))
            total[which[seen > 0]] = seen[seen > 0]
            b /= total
            rest, room = 1.0 - b, np.maximum(1.0 - e, 1e-12)
            distance = a + rest * np.log(np.maximum(rest, 1e-300) / room)
            weight = np.where((b > 0) & (distance >= divergence), rest / room, 0.0)
            value = np.where(wanted, weight.view(np.int64)[which], (weight > 0)[which])
    out, at = [], 0
    for block, size in zip(asked.column("block").to_pylist(), sizes):
        mine, numbers = value[at:at + size], None if code is None else code[at:at + size]
        at += size
        if mine.any() or fresh:
            if numbers is not None:
                numbers = numbers[numbers >= 0]
                numbers = packed(np.diff(numbers, prepend=0) if kind else numbers) if len(numbers) else None
            out.append((block, kind, part, packed(mine), fresh, numbers))
            fresh = 0
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(
        zip(*out) if out else [[]] * len(arrow), arrow)], schema=arrow)


def _answered(asked: DataFrame, name: str, parts: int, cfg: Settings) -> DataFrame:
    """The table ``name`` with the answers added, one exchange to their blocks."""
    arrow, divergence = _arrow(asked.sparkSession, TABLE), cfg.divergence
    got = asked.groupBy("kind", "part").applyInArrow(
        lambda table: _answer(table, arrow, divergence,
                              cfg.numbered(table.column("kind")[0].as_py())), TABLE)
    return stored(got.repartition(min(parts, BUCKETS), "block"), name, parts)


def corpus_counts(corpus: DataFrame, name: str, parts: int, cfg: Settings) -> tuple[DataFrame, int, int]:
    """Training counts of every block's words as rows of the table; N and V."""
    n = corpus.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    arrow = _arrow(corpus.sparkSession, ASKED)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                vocab = expanded(row["vocab"]).split(b" ")
                trained = unpacked(row["trained"])
                order, stretches = dealt(unpacked(row["deal"]), parts)
                for part, at in stretches:
                    yield batch_of(arrow, [0], [part], [row["block"]],
                                   [squeezed(b" ".join([vocab[i] for i in order[at]]))],
                                   [packed(trained[order[at]])], [None], [None])

    counts = _answered(corpus.select("block", "deal", "vocab", "trained").mapInArrow(run, ASKED),
                       name, parts, cfg)
    return counts, n, counts.agg(F.coalesce(F.sum("fresh"), F.lit(0))).first()[0]


def _rows(table: pa.Table) -> Iterator[dict]:
    """The rows of a table of blocks, decoded."""
    for row in table.to_pylist():
        yield row | {c: unpacked(row[c]) for c in ("ends", "tokens", "deal")}


class Known:
    """What a block got, by kind and part."""

    def __init__(self, table: pa.Table, parts: int):
        self.got, self.parts = defaultdict(dict), parts
        for kind, part, *row in zip(*(table.column(c).to_pylist() for c in ("kind", "part", "body", "code"))):
            self.got[kind][part] = row

    def __contains__(self, kind: int) -> bool:
        return kind in self.got

    def answers(self, kind: int, order: np.ndarray, stretches: list) -> Iterator[tuple]:
        for part, at in stretches:
            if part in self.got[kind]:
                body, code = self.got[kind][part]
                yield part, order[at], unpacked(body), code

    def words(self, deal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Training counts and numbers of words (-1: not seen twice)."""
        out, number = np.zeros(len(deal), np.int64), np.full(len(deal), -1, np.int64)
        for part, at, body, code in self.answers(0, *dealt(deal, self.parts)):
            out[at] = body
            if code:
                number[at[body >= 2]] = unpacked(code) * self.parts + part
        return out, number

    def grams(self, kind: int, context: np.ndarray, word: np.ndarray, numbered: float
              ) -> tuple[np.ndarray, np.ndarray]:
        """The answers of grams and their numbers (-1: no contexts)."""
        out, number = np.zeros(len(word), np.int64), np.full(len(word), -1, np.int64)
        for part, at, body, code in self.answers(
                kind, *dealt(gram_parts(context, word, self.parts), self.parts)):
            out[at] = body
            if code:
                number[at[body >> 1 >= numbered]] = np.cumsum(unpacked(code)) * self.parts + part
        return out, number

    def states(self, kind: int, context: np.ndarray) -> np.ndarray:
        """The back-off weights of contexts, in order of their numbers; 0 of no state."""
        out = np.zeros(len(context))
        for _, at, body, _ in self.answers(kind, *dealt(context % self.parts, self.parts)):
            out[at] = body.view(float)
        return out


def contexts(ctx: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The distinct contexts that stand before tokens (-1: none), in the order ``by``."""
    seen = np.zeros(by.max(initial=-1) + 2, bool)
    seen[ctx] = True                # no context: the last
    return by[seen[by]]


def walk(row: dict, known: Known, depth: int, cfg: Settings, n: int, v: int,
         asking: int = 0) -> SimpleNamespace:
    """A block's tokens with the contexts and grams of 1 ... ``depth`` words,
    and each token's probability by the states known so far.  ``asking`` is the
    length of the contexts whose grams are asked for, the states asked for are
    one word shorter: what only the questions need is left out elsewhere."""
    tokens = row["tokens"]
    lengths = np.diff(row["ends"], prepend=0)
    room = np.arange(len(tokens)) - np.repeat(row["ends"] - lengths, lengths)
    c, number = known.words(row["deal"])
    by, place = places(number)
    words, last_at = len(by), place[tokens]
    unigram = (c + ALPHA) / (n + ALPHA * (v + 1))
    p = unigram[tokens]
    out = SimpleNamespace(tokens=tokens, c=c, unigram=unigram, levels=[])
    at_token = c[tokens]
    head = at_token >= cfg.least(1, n) if depth else None
    twice = at_token >= 2
    # gram that ends at each token, its count; counts and numbers of the grams (of no gram: last)
    ids, seen, total, key = tokens, at_token, c, number
    for d in range(1, depth + 1):
        good = room >= d
        good[1:] &= (ids[:-1] >= 0) & (seen[:-1] >= cfg.least(d, n)) & head[:-1]
        ctx = np.full(len(tokens), -1, np.int64)
        ctx[1:] = np.where(good[1:], ids[:-1], -1)
        # what is seen twice has a last word seen twice, and so has its suffix
        use = good & twice
        if d > 1 and cfg.min_share is None and not cfg.min_next:
            use &= seen >= 2
        use = np.flatnonzero(use)
        if d > 1:
            by, place = places(key)
        first, which = distinct(place[ctx[use]] * words + last_at[use], len(by) * words)
        gram = np.full(len(tokens), -1, np.int64)
        gram[use] = which               # of no gram: the last, not kept
        of = ctx[use[first]]
        level = SimpleNamespace(ctx=ctx, gram=gram, total=total, ctx_key=key, by=by, of=of, context=key[of],
                                word=number[tokens[use[first]]], number=np.full(len(of), -1, np.int64),
                                kept=np.zeros(len(of) + 1, np.int64), own=np.zeros(len(of), bool))
        if d == asking:
            learn = np.repeat(~np.asarray(row["held"], bool), lengths)
            level.num = np.bincount(which[learn[use]], minlength=len(of))
        if d == asking - 1:
            level.low = p[use[first]]
        if 2 * d - 1 in known:
            value, level.number = known.grams(2 * d - 1, level.context, level.word,
                                              cfg.numbered(2 * d - 1))
            level.kept[:-1] = value >> 1
            if cfg.min_next:
                level.kept[:-1][level.kept[:-1] < cfg.min_next * total[of]] = 0
            level.own = (value & 1).astype(bool)
        if 2 * d in known:
            back = np.zeros(len(total) + 1)
            asked = contexts(ctx, by)
            back[asked] = known.states(2 * d, key[asked])
            weight = back[ctx]              # of no context: the last, 0
            state = np.flatnonzero(weight > 0)
            after = level.kept[gram]
            k = after[state]
            p[state] = np.where(k > 0, (k - cfg.discount) / seen[state - 1],   # of the context
                                weight[state] * p[state])
        elif d < depth:
            after = level.kept[gram]
        out.levels.append(level)
        if d < depth:
            ids, seen, total, key = gram, after, level.kept, np.append(level.number, -1)
    out.p = p
    return out


def _step(corpus: DataFrame, table: DataFrame, d: int, parts: int, cfg: Settings, n: int,
          v: int) -> DataFrame:
    """What the blocks ask: grams of ``d``-word contexts with their counts, and
    states of ``d - 1`` words with sums over the grams that are theirs."""
    arrow = _arrow(corpus.sparkSession, ASKED)

    def run(block: pa.Table, got: pa.Table) -> pa.Table:
        out = []
        for row in _rows(block):
            levels = walk(row, Known(got, parts), min(d, cfg.levels), cfg, n, v, d).levels

            def add(kind, part, key, *sums):
                order, stretches = dealt(part, parts)
                for p, at in stretches:
                    mine = order[at]
                    out.append((kind, p, row["block"], packed(np.diff(key[mine], prepend=0)),
                                *(x if x is None else packed(x[..., mine]) for x in sums)))

            if d <= cfg.levels:
                g = levels[d - 1]
                add(2 * d - 1, gram_parts(g.context, g.word, parts), g.context,
                    g.num.astype(np.int64), g.word // parts, None)
            if d > 1:
                g = levels[d - 2]
                mine = np.flatnonzero(g.own & (g.kept[:-1] > 0))     # one block's each
                of, low = g.of[mine], g.low[mine]
                kept = g.kept[mine] - cfg.discount
                p = kept / g.total[of]
                at = contexts(g.ctx, g.by)
                key, back = g.ctx_key[at], np.zeros(len(g.total) + 1, bool)
                back[g.ctx[g.kept[g.gram] == 0]] = True
                part, key = key % parts, key // parts * 2 + back[at]
                a, b, e = (np.bincount(of, x, len(g.total))[at] for x in (p * np.log(p / low), kept, low))
                add(2 * d - 2, part, key, a, np.stack([np.where(b > 0, g.total[at], 0), b]), e)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(
            zip(*out) if out else [[]] * len(arrow), arrow)], schema=arrow)

    return _meet(corpus, table, run, ASKED)


def _meet(corpus: DataFrame, table: DataFrame, run, schema: str) -> DataFrame:
    """``run`` on every block with its rows of the table."""
    return (corpus.select("block", "ids", "held", "ends", "tokens", "deal").groupBy("block")
            .cogroup(table.groupBy("block")).applyInArrow(run, schema))


def grow(corpus: DataFrame, tree: DataFrame, name: str, parts: int, cfg: Settings, n: int, v: int
         ) -> DataFrame:
    """The tree's table, level by level: contexts by count, then by divergence."""
    for d in range(1, cfg.levels + 2) if n else ():
        tree = _answered(_step(corpus, tree, d, parts, cfg, n, v), name, parts, cfg)
    return tree


def score(corpus: DataFrame, tree: DataFrame, parts: int, cfg: Settings, n: int, v: int
          ) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    id_type = corpus.schema["ids"].dataType.elementType.simpleString()
    schema = (f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, "
              "train_tokens bigint, base_score double, score double")
    arrow = _arrow(corpus.sparkSession, schema)

    def run(block: pa.Table, got: pa.Table) -> pa.Table:
        out = []
        for row in _rows(block):
            w = walk(row, Known(got, parts), cfg.levels if n else 0, cfg, n, v)
            ends, first = row["ends"], 0
            base = np.log10(w.unigram)
            while first < len(ends):          # some documents at a time, one at least
                from_ = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, from_ + SLICE, "right")))
                part = slice(from_, ends[last - 1])
                stop = ends[first:last] - from_
                start = np.concatenate([[0], stop[:-1]])
                sums = [np.add.reduceat(x, start) for x in
                        ((w.c[w.tokens[part]] > 0).astype(np.int64), base[w.tokens[part]],
                         np.log10(w.p[part]))]
                out.append(batch_of(arrow, row["ids"][first:last], row["held"][first:last],
                                    stop - start, sums[0], np.full(len(stop), n), *sums[1:]))
                first = last
        return pa.Table.from_batches(out, arrow)

    return _meet(corpus, tree, run, schema)


def lm_scores(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Scores of every whole text, one row per input row.

    ``base_score`` is the unigram score, ``score`` the tree's log10
    probability of the text.  A null or empty text is the end alone.  Without
    training rows N and V are 0 and every token has the smoothed probability
    1.  A null id is not held out; repeated rows are trained on and scored
    each; other columns are not read; an empty table gives no rows.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // BLOCK_BYTES))
    run = uuid.uuid4().hex[:12]
    spark, words = docs.sparkSession, f"words_{run}"
    tokenise(docs, parts).write.saveAsTable(words)      # with the words, which only their counts need
    corpus = stored(spark.table(words).drop("vocab", "trained", "n"), f"tokens_{run}", parts)
    counts, n, v = corpus_counts(spark.table(words), f"tree_{run}", parts, cfg)
    spark.sql(f"DROP TABLE {words}")
    return score(corpus, grow(corpus, counts, f"tree_{run}", parts, cfg, n, v), parts, cfg, n, v)
