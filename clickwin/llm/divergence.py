"""Source divergence audit (operator 12).

Terms are runs of ASCII letters (A-Z lowered) and characters beyond ASCII.
Counting packs them by length: terms of up to 8 bytes become one uint64 word,
of up to 16 bytes two; equal terms are brought together by a radix sort over
16-bit digits (as many as the length class needs) and counted by runs.  Longer
terms lie in byte-sorted buckets whose width is a power of two, so padding at
most doubles them.  A block's documents are ordered by group (language and
source) first and the sort is stable: the runs of a term hold its groups and
documents in order, and give occurrences and documents at once.

Spark sums the blocks' counts per group and term, keeps each language's terms
found in enough of its documents, and compares the groups of a language in
tiles: some sources against some sources over a part of the terms, as integer
matrices of bounded size.  All arithmetic is in whole numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickwin.llm.common import batch_of, blocks
from clickwin.session import materialize

MIN_DOCS = 10
TOP = 10                    # ranks of part 'term'
SCALE = 1_000_000_000       # p in units of 1e-9
BLOCK_BYTES = 4 << 20
SHORT = 16                  # bytes of the longest packed term
TILE = 256                  # sources on either side of a tile
CELLS = 1 << 20             # (source, term) cells of a tile's matrices

_BYTES = np.arange(256, dtype=np.uint8)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_LOWERED = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
_TERM = _UPPER | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
# the first k bytes of a word whose bytes stand in reading order
_HEAD = np.array([(1 << 64) - (1 << 8 * (8 - k)) for k in range(9)], np.uint64)


def _gather(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of the stretches, one after another."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return data[np.repeat(start - (ends - length), length) + np.arange(total)]


def term_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the terms."""
    edge = np.flatnonzero(np.diff(_TERM[data].view(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2] - edge[::2]


def radix_order(words: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """The stable order of rows of words (the last weighs most), each with the
    number of leading bytes in use: least digit first, 16 bits a pass."""
    order = np.arange(len(words[0][0]))
    for word, used in words:
        for digit in range(4 - (used + 1) // 2, 4):
            key = (word[order] >> np.uint64(16 * digit)).astype(np.uint16)
            order = order[np.argsort(key, kind="stable")]
    return order


def _classes(data: np.ndarray, start: np.ndarray, length: np.ndarray):
    """``(rows, new)`` of each length class: its terms' numbers with equal
    terms together (in their former order), and where a new term begins."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    # any eight bytes in a row as one number, the first byte weighing most
    view = np.ndarray(len(data) + 1, ">u8", padded, strides=(1,))
    for low, high in ((0, 2), (2, 4), (4, 6), (6, 8), (8, SHORT)):
        rows = np.flatnonzero((length > low) & (length <= high))
        if not len(rows):
            continue
        at, n = start[rows], length[rows]
        words = [(view[at].astype(np.uint64) & _HEAD[np.minimum(n, 8)], min(high, 8))]
        if high > 8:
            words.insert(0, (view[at + 8].astype(np.uint64) & _HEAD[n - 8], high - 8))
        order = radix_order(words)
        new = np.zeros(len(rows), bool)
        for word, _ in words:
            new[1:] |= np.diff(word[order]) != 0
        new[0] = True
        yield rows[order], new
    width = SHORT
    longest = int(length.max()) if len(length) else 0
    while width < longest:
        rows = np.flatnonzero((length > width) & (length <= 2 * width))
        width *= 2
        if not len(rows):
            continue
        n = length[rows]
        cells = np.zeros((len(rows), width), np.uint8)
        cells[np.arange(width) < n[:, None]] = _gather(data, start[rows], n)
        text = cells.view(f"S{width}").ravel()
        order = np.argsort(text, kind="stable")
        new = np.ones(len(rows), bool)
        new[1:] = text[order][1:] != text[order][:-1]
        yield rows[order], new


def count_block(data: np.ndarray, ends: np.ndarray, group: np.ndarray):
    """Counts of a block: ``data`` holds the documents' bytes in order of
    ``group``, each followed by a zero byte at ``ends - 1``.  Gives arrays
    ``group, start, length, n, docs``, one row per group and term."""
    data = _LOWERED[data]
    start, length = term_spans(data)
    doc = np.searchsorted(ends, start, "right")
    parts = []
    for rows, new in _classes(data, start, length):
        d = doc[rows]
        g = group[d]
        first = new.copy()                      # of a group within a term
        first[1:] |= np.diff(g) != 0
        fresh = first.copy()                    # of a document within a term
        fresh[1:] |= np.diff(d) != 0
        at = np.flatnonzero(first)
        parts.append((g[at], start[rows[at]], length[rows[at]],
                      np.diff(at, append=len(rows)),
                      np.add.reduceat(fresh.astype(np.int64), at)))
    if not parts:
        return data, [np.zeros(0, np.int64)] * 5
    return data, [np.concatenate(x) for x in zip(*parts)]


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of each term and documents
    that hold it, per group and block (sum them)."""
    schema = "lang string, source string, term string, n bigint, docs bigint"
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)

    def run(batches):
        for part in blocks(batches, "text", BLOCK_BYTES):
            names = part.select(["lang", "source"])
            keys = list(zip(*(names.column(i).to_pylist() for i in range(2))))
            number = {k: i for i, k in enumerate(sorted(set(keys)))}
            group = np.array([number[k] for k in keys], np.int64)
            order = np.argsort(group, kind="stable")
            text = part.column("text").cast(pa.large_binary()).take(pa.array(order))
            size = pc.binary_length(text).to_numpy(zero_copy_only=False)
            ends = np.cumsum(size + 1)
            data = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
            inside = np.ones(len(data), bool)
            inside[ends - 1] = False
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:][:len(text) + 1]
            if offsets[-1] > offsets[0]:
                data[inside] = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
            data, (g, start, length, n, found) = count_block(data, ends, group[order])
            langs, sources = zip(*number) if number else ((), ())
            term = pa.StringArray.from_buffers(
                len(g), pa.py_buffer(np.append(0, np.cumsum(length)).astype(np.int32).tobytes()),
                pa.py_buffer(_gather(data, start, length).tobytes()))
            yield batch_of(arrow, pa.array(langs, pa.string()).take(pa.array(g)),
                           pa.array(sources, pa.string()).take(pa.array(g)), term, n, found)

    return docs.select("lang", "source", "text").mapInArrow(run, schema)


def _share(count: str, total: str) -> Column:
    """p of ``count`` occurrences, exactly (beyond 64 bits inside)."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * (cast({count} as decimal(20,0)) + 2)) "
                  f"div cast({total} as decimal(21,0))")


def _distance(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def compare_tiles(rows: DataFrame) -> DataFrame:
    """``lang, source, item, value``: f summed over a part of the terms, for
    every source of tile ``ti`` and every other one of tile ``tj``, both ways.

    ``rows`` are ``lang, part, ti, tj, tile, source, term, p``: with a null
    term p is that of a term which the source lacks.
    """
    schema = "lang string, source string, item string, value bigint"

    def compare(key, pdf):
        import pandas as pd
        lacks = pdf["term"].isna().to_numpy()
        base, has = pdf[lacks], pdf[~lacks]
        terms, column = np.unique(has["term"].to_numpy().astype(object), return_inverse=True)

        def side(tile):
            mine = base[base["tile"] == tile]
            p = np.repeat(mine["p"].to_numpy(np.int64)[:, None], len(terms), 1)
            row = pd.Series(np.arange(len(mine)), mine["source"])
            use = (has["tile"] == tile).to_numpy()
            p[row[has["source"][use]].to_numpy(), column[use]] = has["p"].to_numpy()[use]
            return mine["source"].to_numpy(), p

        _, _, ti, tj = key
        a, left = side(ti)
        b, right = (a, left) if ti == tj else side(tj)
        out = []
        for i, (name, p) in enumerate(zip(a, left)):
            rest = slice(i + 1, None) if ti == tj else slice(None)
            value = ((p - right[rest]) ** 2 // (p + right[rest])).sum(1)
            for one, other in ((name, b[rest]), (b[rest], name)):
                out.append(pd.DataFrame({"lang": key[0], "source": one, "item": other,
                                         "value": value}, index=range(len(value))))
        return pd.concat(out) if out else pd.DataFrame(
            {"lang": [], "source": [], "item": [], "value": []})

    return rows.groupBy("lang", "part", "ti", "tj").applyInPandas(compare, schema)


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every (lang, source) group.

    Part ``pair``: every other source of the language with the sum of f over
    the language's kept terms.  Part ``term``: the ``top`` terms that the group
    holds and has more of than its language, by f.  Ranks count from 1 by
    falling value, then by the item's bytes.  Null text, lang and source are
    ''.  A language without kept terms has pairs of value 0; a group without
    terms has every kept term with count 0; a language with one source has no
    pair.  Repeated rows are documents of their own; other columns are not
    read; an empty table gives no rows.
    """
    docs = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = materialize(term_counts(docs).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    kept = materialize(counts.groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
        .select("lang", "term", "lang_n"), "kept-terms")
    present = materialize(counts.join(kept, ["lang", "term"])
                          .select("lang", "source", "term", "n", "lang_n"), "kept-counts")

    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = present.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (docs.groupBy("lang", "source").agg(F.count("*").alias("rows"))
              .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"),
                      (F.coalesce("total", F.lit(0)) + 2 * F.coalesce("v", F.lit(0)))
                      .alias("whole"),
                      (F.col("lang_total") + 2 * F.col("v")).alias("lang_whole"))
              .withColumn("p0", F.when(F.col("v") > 0, _share("0", "greatest(whole, 1)"))
                          .otherwise(F.lit(1)).cast("bigint")))
    groups = materialize(groups, "groups")
    shares = materialize(
        present.join(groups, ["lang", "source"])
        .select("lang", "source", "term", _share("n", "whole").cast("bigint").alias("p"),
                _share("lang_n", "lang_whole").cast("bigint").alias("q")), "shares")
    return _ranked(_pairs(groups, shares), "pair").unionByName(
        _ranked(_over(shares), "term", top))


def _over(shares: DataFrame) -> DataFrame:
    return (shares.where("p > q")
            .select("lang", "source", F.col("term").alias("item"),
                    _distance("p", "q").alias("value")))


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """The summed f of every two sources of a language, in tiles."""
    # tiles of the sources and parts of the terms, by a language's numbers of both
    sizes = groups.groupBy("lang").agg(
        F.ceil(F.count("*") / TILE).cast("int").alias("tiles"),
        F.greatest(F.lit(1), F.ceil(F.least(F.count("*"), F.lit(TILE)) * F.max("v") / CELLS))
        .cast("int").alias("parts"))
    tile = F.expr("cast(pmod(xxhash64(source), tiles) as int)").alias("tile")
    lacks = groups.join(sizes, "lang").select(
        "lang", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), "tiles", tile,
        "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"))
    has = shares.join(sizes, "lang").select(
        "lang", F.expr("cast(pmod(xxhash64(term), parts) as int)").alias("part"), "tiles", tile,
        "source", "term", "p")
    rows = (lacks.unionByName(has)
            .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
            .select("lang", "part", F.least("tile", "other").alias("ti"),
                    F.greatest("tile", "other").alias("tj"), "tile", "source", "term", "p"))
    return (compare_tiles(rows).groupBy("lang", "source", "item")
            .agg(F.sum("value").alias("value")))


def _ranked(rows: DataFrame, part: str, limit: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = rows.withColumn("rank", F.row_number().over(order))
    if limit is not None:
        out = out.where(F.col("rank") <= limit)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
