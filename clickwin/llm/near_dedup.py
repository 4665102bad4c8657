"""MinHash near-dedup (operator 9).

One-permutation hashing: one hash per shingle, the least per bin, empty bins
filled by optimal densification (each probes its own random sequence of bins
until one is filled).  Bands of bins are bucket keys.  Documents with equal
shingle sets are one node from the start (the one with the smallest id).

In a bucket the candidates are the edges of a star around its smallest node,
so their number is linear in the bucket.  Every edge is confirmed on the full
shingle sets.  A star can miss a link between two nodes that are both unlike
its centre.  So where a bucket's nodes are not yet in one component, the nodes
outside its largest component are held against the others once more, by
matrix products over blocks of at most BLOCK shingle sets: no link inside a
bucket is lost, no pairs are emitted but links (one per node and component),
and nodes known to be connected are not compared again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwin.llm.common import batch_of, utf8, words
from clickwin.session import materialize

SHINGLE = 5
BANDS, ROWS = 48, 5         # a link of similarity 0.75 shares no bucket with chance 2e-6
BINS = BANDS * ROWS
BLOCK = 1024                # shingle sets on either side of a block
WIDTH = 8192                # shingles of one matrix product


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


POWERS = _mix(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)
PROBE = np.arange(BINS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: bytes | None, known: dict) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; a shorter text is one."""
    seq = words(text)
    if not seq:
        return np.zeros(0, np.uint64)
    h = np.fromiter((known.get(w) or known.setdefault(w, xxhash.xxh64_intdigest(w))
                     for w in seq), np.uint64, len(seq))
    if len(known) > 500_000:
        known.clear()
    n = max(1, len(h) - SHINGLE + 1)
    total = np.full(n, np.uint64(min(len(h), SHINGLE)))
    for i in range(min(SHINGLE, len(h))):
        total += h[i:i + n] * POWERS[i]
    return np.unique(_mix(total))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """One-permutation minima with optimal densification."""
    out = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    at = (hashes % np.uint64(BINS)).astype(np.int64)
    np.minimum.at(out, at, _mix(hashes + np.uint64(0x632BE59BD9B4E019)))
    filled = np.zeros(BINS, bool)
    filled[at] = True
    empty = np.flatnonzero(~filled)
    turn = 1
    while len(empty):
        to = (_mix(PROBE[empty] + np.uint64(turn)) % np.uint64(BINS)).astype(np.int64)
        hit = filled[to]
        out[empty[hit]] = out[to[hit]]
        empty, turn = empty[~hit], turn + 1
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    rows = minima.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return key.view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n, fp, bands`` per row: set size, fingerprint of the full
    set, bucket keys (none for an empty set)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = f"doc_id {id_type}, n bigint, fp binary, bands array<bigint>"
    arrow = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)

    def run(batches):
        known: dict = {}
        with np.errstate(over="ignore"):
            for batch in batches:
                n, fp, bands = [], [], []
                for text in utf8(batch, "text"):
                    h = shingle_hashes(text, known)
                    n.append(len(h))
                    fp.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest()
                              if len(h) else None)
                    bands.append(band_keys(sketch(h)) if len(h) else None)
                yield batch_of(arrow, batch.column("doc_id"), n, fp, bands)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _shingles(text: bytes | None) -> set:
    w = words(text)
    return {tuple(w[i:i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))} if w else set()


def confirm(pairs: DataFrame, texts: DataFrame, percent: int = 75) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity.

    The text of ``b`` travels once per pair; that of ``a`` is attached in the
    task that compares.
    """
    schema = pairs.select("a", "b").schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def run(batches):
        last, sets = None, set()
        for batch in batches:
            keep = []
            for i, (a, ta, tb) in enumerate(zip(batch.column("a").to_pylist(),
                                                utf8(batch, "ta"), utf8(batch, "tb"))):
                if last != (a, ta):
                    last, sets = (a, ta), _shingles(ta)
                other = _shingles(tb)
                both = len(sets & other)
                if both and 100 * both >= percent * (len(sets) + len(other) - both):
                    keep.append(i)
            got = batch.take(pa.array(keep, pa.int64()))
            yield batch_of(arrow, got.column("a"), got.column("b"))

    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    return (pairs.join(b.hint("merge"), "b").join(a.hint("merge"), "a")
            .select("a", "b", "ta", "tb").mapInArrow(run, schema))


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` (the smallest node reachable) of every node on an edge.

    Alternating large and small stars; each round is a written table and ends
    when no edge changes.  Hot nodes are rows of the larger join side, which
    AQE splits.
    """
    e = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where("u > v").distinct(), "edges")
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").where("v > m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = materialize(small, "stars")
        now = _state(e)
        if now == state:
            break
        state = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()))


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def link(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when their shingle sets have a similarity of at least
    ``percent``; a component's id is its smallest doc_id and that document is
    kept.  Null and empty texts (and texts of white space) have no shingle and
    no link: they are kept, alone, also beside a row of the same id that has
    words.  Rows with equal ids are one node.  A row with a null id has no
    link, a null component and is kept.  Other columns are not read; an empty
    table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    sigs = materialize(signatures(docs), "signatures")
    named = sigs.where("n > 0 and doc_id is not null")
    reps = materialize(named.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "reps")
    keys = (named.join(reps, ["fp", "doc_id"], "left_semi")
            .select("doc_id", F.explode("bands").alias("key")))
    shared = keys.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("top")
                                     ).where("hub < top").select("key", "hub")
    buckets = materialize(keys.join(shared, "key"), "buckets")       # key, doc_id, hub

    pairs = (buckets.where("doc_id <> hub")
             .select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct())
    pairs = materialize(pairs, "pairs")
    nodes = (pairs.select(F.col("a").alias("doc_id"))
             .unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct())
    # every text of a bucket with two nodes; all later rounds compare these only
    # (a merge join: the list of nodes grows with the table, so it is never broadcast)
    # (a repeated id may have a null text beside another one)
    texts = materialize(docs.where("text is not null")
                        .join(nodes.hint("merge"), "doc_id", "left_semi"), "texts")
    edges = materialize(confirm(pairs, texts, percent), "links")
    labels = components(edges)
    open_ = _open_units(buckets, labels)
    if not open_.isEmpty():
        more = materialize(_links_across(open_, texts, percent), "links")
        more = materialize(confirm(more, texts, percent), "links")
        labels = components(edges.unionByName(more))
    named_reps = (reps.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                  .select("fp", F.coalesce("label", "doc_id").alias("label")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return (sigs.select("doc_id", "n", "fp").join(named_reps, "fp", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                    F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")))


def _open_units(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes of buckets that span several components, by unit: the buckets
    with the same largest component.  ``unit, doc_id, label`` once each."""
    now = (buckets.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
           .select("key", "doc_id", F.coalesce("label", "doc_id").alias("label")))
    parts = now.groupBy("key", "label").agg(F.count("*").alias("rows"))
    mixed = (parts.groupBy("key").agg(F.max_by("label", F.struct("rows", "label")).alias("unit"),
                                      F.count("*").alias("parts")).where("parts > 1"))
    return materialize(now.join(mixed.select("key", "unit"), "key")
                       .select("unit", "doc_id", "label").distinct(), "open-buckets")


def _links_across(open_: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between nodes outside a unit's main component and nodes of
    its other components.  Large units are dealt into blocks, so a task holds
    at most about 2 * BLOCK texts."""
    out = F.col("label") != F.col("unit")
    sizes = open_.groupBy("unit").agg(
        F.ceil(F.count(F.when(out, 1)) / BLOCK).cast("int").alias("ni"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("nj"))
    rows = open_.join(sizes, "unit").withColumn("h", F.xxhash64("doc_id"))
    left = (rows.where(out).withColumn("i", F.expr("pmod(h, ni)"))
            .withColumn("j", F.explode(F.expr("sequence(0, nj - 1)"))).withColumn("left", F.lit(True)))
    right = (rows.withColumn("j", F.expr("pmod(h, nj)"))
             .withColumn("i", F.explode(F.expr("sequence(0, ni - 1)")))
             .withColumn("left", F.lit(False)))
    cols = ["unit", "i", "j", "left", "doc_id", "label"]
    id_type = open_.schema["doc_id"].dataType.simpleString()
    schema = f"a {id_type}, b {id_type}"

    def compare(pdf):
        import pandas as pd
        if pdf["left"].all() or not pdf["left"].any():       # nothing on one side
            return pd.DataFrame({"a": [], "b": []})
        known: dict = {}
        with np.errstate(over="ignore"):
            sets = [shingle_hashes(t.encode(), known) for t in pdf["text"]]
        side, ids, label = (pdf[c].to_numpy() for c in ("left", "doc_id", "label"))
        x, y = np.flatnonzero(side), np.flatnonzero(~side)
        n = np.array([len(h) for h in sets])
        both = np.zeros((len(x), len(y)), np.float32)
        shared = np.intersect1d(np.concatenate([sets[k] for k in x]),
                                np.concatenate([sets[k] for k in y]))
        for at in range(0, len(shared), WIDTH):
            part = shared[at:at + WIDTH]
            both += _presence(sets, x, part) @ _presence(sets, y, part).T
        ok = 100 * both >= percent * (n[x][:, None] + n[y][None, :] - both)
        ok &= label[x][:, None] != label[y][None, :]
        links = []
        for k in np.flatnonzero(ok.any(1)):
            found = y[ok[k]]
            _, first = np.unique(label[found], return_index=True)    # one per component
            links += [(min(ids[x[k]], ids[m]), max(ids[x[k]], ids[m])) for m in found[first]]
        return pd.DataFrame(links, columns=["a", "b"])

    return (left.select(*cols).unionByName(right.select(*cols)).join(texts, "doc_id")
            .groupBy("unit", "i", "j").applyInPandas(compare, schema).distinct())


def _presence(sets: list, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the sorted ``values`` each set holds."""
    out = np.zeros((len(rows), len(values)), np.float32)
    for i, k in enumerate(rows):
        at = np.minimum(np.searchsorted(values, sets[k]), len(values) - 1)
        out[i, at[values[at] == sets[k]]] = 1
    return out


def near_dedup(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` without the documents that are not their component's smallest
    (see ``link``); repeated rows of a kept id stay."""
    gone = link(docs, percent).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
