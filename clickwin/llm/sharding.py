"""Sharding by histogram sort (operator 5), DataFrame functions only.

Rows are ordered by (hash of the text, hash of the id), so equal texts lie
together, and cut into contiguous shards of nearly equal bytes.  The cuts are
found by rounds of exact counting: each round divides every open interval of
the key space at evenly spaced probes, all partitions sum the bytes between
probes (a partial aggregate; a hot text is one row per task), and the probe
interval around a wanted cut becomes the next, narrower one until a probe is
within ``tolerance``.  A text group is cut only where it alone spans more
than the tolerance; then the cut is refined along the hash of the id.  The
documents are exchanged once, by (shard, lane).

The driver sees histograms only: at most FIRST_PROBES, then PROBES rows per
cut.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickwin.session import materialize

FIRST_PROBES, PROBES = 4096, 256
TOP = 1 << 62


def _key62(col: Column) -> Column:
    """A 62-bit hash: differences of two keys cannot overflow."""
    return F.shiftrightunsigned(F.xxhash64(col), 2)


def _histogram(keys: DataFrame, dim: str, spans: list[tuple], cells: int) -> dict:
    """Exact bytes and key range of every non-empty cell of every span.

    A span is (h0, h1) on dimension ``h`` or (h, g0, g1) on ``g``, ends
    included; the result maps span -> [(cell, bytes, least key, greatest)].
    """
    span = cell = None
    for i, s in enumerate(spans):
        lo, hi = s[-2:]
        inside = F.col(dim).between(lo, hi)
        if dim == "g":
            inside &= F.col("h") == s[0]
        width = _width(lo, hi, cells)
        here = F.expr(f"({dim} - {lo}L) div {width}L")
        span = F.when(inside, i) if span is None else span.when(inside, i)
        cell = F.when(inside, here) if cell is None else cell.when(inside, here)
    rows = (keys.select(span.alias("span"), cell.alias("cell"), "size", dim)
            .where(F.col("span").isNotNull()).groupBy("span", "cell")
            .agg(F.sum("size").alias("bytes"), F.min(dim).alias("lo"), F.max(dim).alias("hi"))
            .orderBy("span", "cell").collect())
    out: dict = {s: [] for s in spans}
    for r in rows:
        out[spans[r["span"]]].append((r["cell"], r["bytes"], r["lo"], r["hi"]))
    return out


def _width(lo: int, hi: int, cells: int) -> int:
    return max(1, -(-(hi - lo + 1) // cells))


def splitters(keys: DataFrame, shards: int, tolerance: float = 0.005) -> list[tuple[int, int]]:
    """``shards - 1`` cuts (H, G); a row lies left of a cut if ``h < H`` or
    ``h = H and g < G``.  ``keys``: h, g, size (a written, narrow table)."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    allowed = tolerance * total / shards
    cuts: dict[int, tuple[int, int]] = {}
    #: wanted cut -> (dimension, span that contains it, bytes before the span)
    open_at = {i: ("h", (0, TOP - 1), 0) for i in range(1, shards)}
    cells = FIRST_PROBES
    while open_at:
        found = {dim: _histogram(keys, dim, spans, cells) for dim in ("h", "g")
                 if (spans := sorted({s for d, s, _ in open_at.values() if d == dim}))}
        for i, (dim, span, before) in list(open_at.items()):
            want = total * i / shards - before
            hist = found[dim][span]
            below = [0, *accumulate(b for _, b, _, _ in hist)]
            at = min(bisect_left(below, want, 1), len(hist)) - 1     # cell holding the cut
            cell, _, lo, hi = hist[at]
            left, right = want - below[at], below[at + 1] - want
            if min(left, right) > allowed and (lo < hi or dim == "h"):
                # one key left: its rows are told apart by the other hash
                open_at[i] = ((dim, (*span[:-2], lo, hi), before + below[at]) if lo < hi
                              else ("g", (lo, 0, TOP - 1), before + below[at]))
                continue
            key = lo if left <= right else hi + 1       # no key lies between probe and these
            cuts[i] = (key, 0) if dim == "h" else (span[0], key)
            del open_at[i]
        cells = PROBES
    return [cuts[i] for i in sorted(cuts)]


def shard_documents(docs: DataFrame, shards: int = 40, tolerance: float = 0.005,
                    lane_bytes: int = 128 << 20) -> DataFrame:
    """``docs`` with ``size, text_crc32, shard, slot``.

    ``size`` is the UTF-8 bytes of ``text`` (null: none) plus 16 and
    ``text_crc32`` their CRC-32 (null: as empty).  Law: every shard's bytes
    are equal up to ``tolerance`` of a shard on either cut, or one document
    where a single one is larger.  Slots count from 0 without gaps within a
    shard.  Shards larger than ``lane_bytes`` are numbered by several tasks
    (lanes).  Rows equal in text and id share a key and a shard, each with a
    slot of its own.  A null id is a key like another.  Input columns named
    like an output are replaced; an empty table gives an empty result.
    ``docs`` must be repeatable (a table): it is read once for keys and once
    for the exchange.
    """
    kept = [c for c in docs.columns if c not in ("size", "text_crc32", "shard", "slot")]
    rows = docs.select("doc_id", "text", F.struct(*kept).alias("row"))
    return (place(rows, shards, tolerance, lane_bytes, "row")
            .select("row.*", "size", "text_crc32", "shard", "slot"))


def place(docs: DataFrame, shards: int = 40, tolerance: float = 0.005,
          lane_bytes: int = 128 << 20, *carry: str) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` and the ``carry`` columns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", *carry,
                        (F.octet_length(text) + 16).cast("bigint").alias("size"),
                        F.crc32(text).alias("text_crc32"),
                        _key62(text).alias("h"), _key62(F.col("doc_id")).alias("g"))
    keys = materialize(keyed.select("size", "h", "g"), "shard-keys")
    cuts = splitters(keys, shards, tolerance)
    total = keys.agg(F.sum("size")).first()[0] or 0
    lanes = max(1, math.ceil(total / shards / lane_bytes))
    shard = " + ".join(f"int(h > {H}L or (h = {H}L and g >= {G}L))" for H, G in cuts) or "0"
    placed = {"shard": F.expr(shard), "lane": F.expr(f"pmod(xxhash64(g, h), {lanes})")}

    # exact rows per lane; the first slot of each lane follows from them
    offsets = (keys.withColumns(placed).groupBy("shard", "lane").agg(F.count("*").alias("n"))
               .select("shard", "lane", (F.sum("n").over(
                   Window.partitionBy("shard").orderBy("lane")) - F.col("n")).alias("from")))
    order = Window.partitionBy("shard", "lane").orderBy("h", "g")
    return (keyed.withColumns(placed).withColumn("number", F.row_number().over(order))
            .join(offsets, ["shard", "lane"])
            .select("doc_id", *carry, "size", "text_crc32", "shard",
                    (F.col("from") + F.col("number") - 1).cast("bigint").alias("slot")))
