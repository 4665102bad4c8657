"""SimHash near-dedup (operator 11).

A fingerprint has a bit for every bit of the 64-bit hashes of a text's 3-word
shingles: it is 1 if set in over half of them, repeats included.  Texts are
linked at ``RADIUS`` = 3 or fewer differing bits.

Multi-index hashing over the distinct fingerprints: each has two segments of
32 bits, and of two linked ones some segment differs in at most one bit.  A
segment table holds every fingerprint under its segment's value; a fingerprint
fetches the values of the Hamming ball of radius 1 around its own (of two
values at distance 1, the one without the bit fetches the other), and complete
distances are verified in the join.

A value under which more than ``LOAD`` fingerprints lie is hot: fetching there
would compare about all pairs of them.  The fingerprints in or next to hot
values meet by whole values instead.  All within distance 1 of one value are
within 2 of each other, so a star over each such value finds every link of
distance 2 or less, in rows linear in the fingerprints.  A link of distance 3
has a value at distance 2 from one end and 1 from the other: only fingerprints
outside their neighbourhood's main component look for those, as links inside a
component change nothing.  No link is lost and no pairs of a hot value are
listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwin.llm.common import batch_of, utf8, words
from clickwin.llm.near_dedup import components
from clickwin.session import materialize

SHINGLE = 3
SEED = 42
RADIUS = 3
BITS = 64
SEGMENT = 32                # bits of a segment; two of them: RADIUS // 2 = 1 in either
LOAD = 64                   # fingerprints under one segment value that are compared there
PIECE = 1 << 16             # hashes counted at a time


def _hashes(seq: list[bytes]) -> Iterator[int]:
    """XXH64 of the space-joined shingles, repeats included."""
    grams = zip(*(seq[i:] for i in range(SHINGLE))) if len(seq) > SHINGLE else iter([seq])
    return map(xxhash.xxh64_intdigest, map(b" ".join, grams), repeat(SEED))


def fingerprint(text: bytes | None) -> int:
    """The fingerprint as an unsigned number; zero without words."""
    seq = words(text)
    if not seq:
        return 0
    hashes, n, ones = _hashes(seq), 0, np.zeros(BITS, np.int64)
    while len(part := np.fromiter(islice(hashes, PIECE), "<u8")):
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
        n += len(part)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` per row (the 64 bits as a signed number)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, fp bigint"
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)

    def run(batches):
        for batch in batches:
            fps = np.fromiter(map(fingerprint, utf8(batch, "text")), np.uint64, batch.num_rows)
            yield batch_of(arrow, batch.column("doc_id"), pa.array(fps.view(np.int64)))

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _masks(bits: int, *weights: int) -> Column:
    """All patterns of ``bits`` bits with one of the numbers of ones."""
    values = [sum(1 << i for i in at) for w in weights for at in combinations(range(bits), w)]
    return F.array(*[F.lit(v - (1 << 64) if v >> 63 else v) for v in values])


def _differ(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def segments(fps: DataFrame) -> DataFrame:
    """The segment tables: ``key, fp``, a key being a segment's number and value."""
    low = F.col("fp").bitwiseAND(F.lit((1 << SEGMENT) - 1))
    high = F.shiftrightunsigned("fp", SEGMENT) + F.lit(1 << SEGMENT)
    return fps.select("fp", F.explode(F.array(low, high)).alias("key"))


def ball_links(table: DataFrame) -> DataFrame:
    """Links ``a, b`` by fetching balls of radius 1 from the segment tables."""
    probes = (table.withColumn("flip", F.explode(_masks(SEGMENT, 0, 1)))
              .where(F.col("key").bitwiseAND(F.col("flip")) == 0)
              .select(F.col("key").bitwiseOR(F.col("flip")).alias("key"), F.col("fp").alias("a"),
                      (F.col("flip") == 0).alias("own")))
    held = table.select("key", F.col("fp").alias("b"))
    return (probes.join(held, "key")
            .where((_differ("a", "b") <= RADIUS)
                   & F.when(F.col("own"), F.col("a") < F.col("b")).otherwise(True))
            .select("a", "b"))


def hot_keys(table: DataFrame, load: int) -> DataFrame:
    return table.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > load).select("key")


def _around(hot: DataFrame, table: DataFrame) -> DataFrame:
    """``hot, fp``: the fingerprints in or next to each hot segment value."""
    near = (hot.select(F.col("key").alias("hot"), F.explode(_masks(SEGMENT, 0, 1)).alias("flip"))
            .select("hot", F.col("hot").bitwiseXOR(F.col("flip")).alias("key")))
    return near.join(table, "key").select("hot", "fp")


def _balls(fps: DataFrame, *weights: int) -> DataFrame:
    """``value, fp``: the whole values that differ in so many bits."""
    return (fps.select("fp", F.explode(_masks(BITS, *weights)).alias("flip"))
            .select(F.col("fp").bitwiseXOR(F.col("flip")).alias("value"), "fp"))


def near_stars(fps: DataFrame) -> DataFrame:
    """Links that connect all ``fps`` at distance 2 or less: a star over every
    value with two of them within distance 1."""
    balls = _balls(fps, 0, 1)
    hubs = (balls.groupBy("value").agg(F.min("fp").alias("a"), F.max("fp").alias("top"))
            .where("a < top").select("value", "a"))
    return (balls.join(hubs, "value").where("fp <> a")
            .select("a", F.col("fp").alias("b")).distinct())


def far_links(around: DataFrame, labels: DataFrame) -> DataFrame:
    """Links of distance 3 between components, at hot segment values.

    ``around`` is ``hot, fp``; ``labels`` the components by all other links.
    """
    known = (around.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
             .select("hot", "fp", F.coalesce("label", "fp").alias("label")))
    parts = known.groupBy("hot", "label").agg(F.count("*").alias("rows"))
    mixed = (parts.groupBy("hot").agg(F.max_by("label", F.struct("rows", "label")).alias("main"),
                                      F.count("*").alias("parts")).where("parts > 1"))
    open_ = materialize(known.join(mixed.select("hot", "main"), "hot"), "simhash-open")
    # those within distance 1 of a value are one component already: its least stands for all
    near = _balls(open_.select("fp").distinct(), 1).groupBy("value").agg(F.min("fp").alias("b"))
    minor = open_.where("label <> main").select("fp").distinct()
    return (_balls(minor, 2).join(near, "value").where("fp <> b")
            .select(F.col("fp").alias("a"), "b").distinct())


def links(fps: DataFrame, load: int = LOAD) -> DataFrame:
    """Links ``a, b`` whose components are those of all links between the
    distinct fingerprints ``fps``; every row is a link itself."""
    table = segments(fps)
    hot = materialize(hot_keys(table, load), "simhash-hot")
    if hot.isEmpty():
        return materialize(ball_links(table).distinct(), "simhash-links")
    light = table.join(hot, "key", "left_anti")
    around = materialize(_around(hot, table), "simhash-around")
    found = materialize(ball_links(light).unionByName(
        near_stars(around.select("fp").distinct())).distinct(), "simhash-links")
    return found.unionByName(
        materialize(far_links(around, components(found)), "simhash-links"))


def simhash(docs: DataFrame, load: int = LOAD) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    Texts without words (null, empty, white space) have fingerprint zero and
    are linked by it like any other.  Rows with equal ids are one document:
    its fingerprints are connected.  A row with a null id has its fingerprint,
    no link and a null component.  Other columns are not read; an empty table
    gives no rows.
    """
    sigs = materialize(fingerprints(docs), "simhash")
    named = sigs.where("doc_id is not null")
    reps = materialize(named.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-reps")
    same = (named.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("top"))
            .where("a < top").select("doc_id", "a"))
    same = (named.join(same, "doc_id").where("fp <> a")
            .select("a", F.col("fp").alias("b")).distinct())
    labels = components(links(reps.select("fp"), load).unionByName(same))
    classed = (reps.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
               .select("fp", "doc_id", F.coalesce("label", "fp").alias("label")))
    least = classed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of = classed.join(least, "label").select("fp", "component_id")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return (sigs.join(of, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    component.alias("component_id")))
