"""Mixing sources to target weights (operator 7).

Targets: sources in code point order, null last, weigh 1, 2, 3, 1, ... and
share all words; a target stops at ``cap`` times its source's words and the
excess goes to the others by weight (water filling).

Draws: each source's documents are dealt into blocks by a permuting hash of
their id.  A source is taken ``floor(target / words)`` times whole, and once
more block after block in permuted order until its target is met; the one
block that crosses it is drawn document by document.  The number of draws of
every source (its exact block quota) is split among the output shards by a
tree: each node divides its quota vector between its two halves by a
multivariate hypergeometric draw.  A shard then takes its quota of the next,
disjoint draws of the source's permuted order, and rows are shuffled inside
the shard.

The driver sees one row per source.  Rows meet the plan by (source, block),
so a source with a third of all rows is spread over its blocks.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickwin.session import materialize

HEX = 2                     # 16^HEX blocks per source
SMALL_PLAN = 20_000         # plan rows (about 100 bytes each) up to which it is broadcast
WORD_BYTES = 6


def words_in(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: list[tuple], cap: float = 3.0, weights=(1, 2, 3)) -> list[float]:
    """Target words of sources given in order as (name, words).

    Sources by rising ``cap * words / weight``: the first ones stop at their
    cap, the others share what is left by weight.
    """
    weigh = [weights[i % len(weights)] for i in range(len(sizes))]
    order = sorted(range(len(sizes)), key=lambda i: (cap * sizes[i][1] / weigh[i], i))
    left, load = float(sum(n for _, n in sizes)), float(sum(weigh))
    out = [0.0] * len(sizes)
    for at, i in enumerate(order):
        most = cap * sizes[i][1]
        if most * load > left * weigh[i]:
            level = left / load
            for j in order[at:]:
                out[j] = level * weigh[j]
            break
        out[i] = most
        left, load = left - most, load - weigh[i]
    return out


def splitting_tree(quotas: np.ndarray, shards: int, rng) -> np.ndarray:
    """(shards x sources) draws; every leaf gets an equal share (up to one) of
    all draws, drawn without replacement."""
    if shards == 1:
        return quotas[None, :]
    half = shards // 2
    share = int(quotas.sum()) * half // shards
    # "marginals": a chain of univariate draws, no array of all draws; numpy
    # takes fewer than 1e9 draws, which is over a million sources
    left = (rng.multivariate_hypergeometric(quotas, share, method="marginals")
            if quotas.sum() else quotas)
    return np.vstack([splitting_tree(left, half, rng),
                      splitting_tree(quotas - left, shards - half, rng)])


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """Adds source key, permuting key and block of each row."""
    perm = F.md5(F.concat(F.lit(f"{seed}:"),
                          F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.withColumns({
        "key__": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")),
        "perm__": perm, "block__": F.substring(perm, 1, HEX)})


def plan_mix(docs: DataFrame, shards: int = 16, cap: float = 3.0, seed: int = 7
             ) -> DataFrame:
    """``docs`` (without columns named like an output or ending in ``__``)
    with ``size, source_size, target`` and ``places``: the output shards that
    take the document, one entry per copy (none: not taken)."""
    spark = docs.sparkSession
    kept = [c for c in docs.columns if not c.endswith("__")
            and c not in ("size", "source_size", "target", "places")]
    sized = _keyed(docs.select(*kept, words_in(F.col("text")).alias("size")), seed)
    rows = materialize(sized.select("source", "key__", "perm__", "block__", "size"), "mix-sizes")
    per_block = materialize(rows.groupBy("source", "key__", "block__")
                            .agg(F.sum("size").alias("words")), "mix-blocks")
    sources = (per_block.groupBy("source", "key__")
               .agg(F.sum("words").alias("words"), F.count("*").alias("blocks")).collect())
    sources.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    goal = targets([(r["source"], r["words"]) for r in sources], cap)
    whole = [int(t // r["words"]) if r["words"] else 0 for t, r in zip(goal, sources)]
    need = [t - e * r["words"] for t, e, r in zip(goal, whole, sources)]
    names = spark.createDataFrame(
        [(r["key__"], r["words"], t, e, n) for r, t, e, n in zip(sources, goal, whole, need)],
        "key__ string, source_size bigint, target double, whole__ int, need__ double")

    # blocks in permuted order: drawn once more whole, in part or not
    order = Window.partitionBy("key__").orderBy("block__")
    before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    blocks = (per_block.join(names, "key__").withColumn("before__", before)
              .withColumn("extra__", F.col("need__") > F.col("before__"))
              .withColumn("cross__", F.col("extra__")
                          & (F.col("before__") + F.col("words") > F.col("need__"))))
    blocks = materialize(blocks.withColumn("draws__", F.col("whole__")
                                           + F.col("extra__").cast("int")), "mix-draws")

    quota = {r["key__"]: r["n"] for r in
             blocks.groupBy("key__").agg(F.sum("draws__").alias("n")).collect()}
    split = splitting_tree(np.array([quota.get(r["key__"], 0) for r in sources], np.int64),
                           shards, np.random.default_rng(seed)) if sources else []
    ends = spark.createDataFrame(
        [(r["key__"], [int(x) for x in np.cumsum(split[:, i])]) for i, r in enumerate(sources)],
        "key__ string, ends__ array<bigint>")
    # the source's draws in permuted order, copy after copy; the shard of draw
    # k is the number of quotas that end at or below k
    at = Window.partitionBy("key__").orderBy("copy", F.md5(F.concat("copy", "block__")))
    places = (blocks.where("draws__ > 0")
              .select("key__", "block__", F.explode(F.expr("sequence(1, draws__)")).alias("copy"))
              .withColumn("k", F.row_number().over(at) - 1).join(ends, "key__")
              .select("key__", "block__", "copy",
                      F.expr("size(filter(ends__, e -> e <= k))").alias("shard"))
              .groupBy("key__", "block__")
              .agg(F.transform(F.array_sort(F.collect_list(F.struct("copy", "shard"))),
                               lambda x: x["shard"]).alias("places")))
    plan = materialize(blocks.drop("source").join(places, ["key__", "block__"], "left"), "mix-plan")

    # documents of the crossing blocks, one block per source
    inner = Window.partitionBy("key__").orderBy("perm__", "size")
    crossing = rows.join(plan.where("cross__").select("key__", "block__", "before__", "need__"),
                         ["key__", "block__"])
    sofar = F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    limits = (crossing.withColumn("end__", F.col("before__") + sofar)
              .where("2 * end__ - size <= 2 * need__")
              .groupBy("key__").agg(F.max("perm__").alias("until__")))
    plan = plan.join(limits, "key__", "left").select(
        "key__", "block__", "source_size", "target", "places", "cross__", "until__")
    if plan.count() <= SMALL_PLAN:          # else Spark shuffles both sides
        plan = F.broadcast(plan)
    drawn = (F.col("cross__") & (F.col("until__").isNull() | (F.col("perm__") > F.col("until__"))))
    places = F.coalesce("places", F.array().cast("array<int>"))
    return (sized.join(plan, ["key__", "block__"])
            .withColumn("places", F.when(drawn, F.slice(places, 1, F.size(places) - 1))
                        .otherwise(places))
            .select(*kept, "size", "source_size", "target", "places"))


def mix(docs: DataFrame, shards: int = 16, cap: float = 3.0, seed: int = 7,
        lane_bytes: int = 128 << 20) -> DataFrame:
    """The mixed rows: ``docs`` columns plus ``mix_shard`` and ``mix_copy``,
    each document as often as drawn, shuffled within its shard.

    Word counts come near the targets up to one document per source; no
    document is taken more than ``ceil(cap)`` times.  Null texts have no words
    and follow their block; a null source is a source of its own; a null id
    hashes as an empty one.  Rows with equal ids share a place in the order
    and are drawn together.  An empty table gives an empty result; input
    columns named like an output are replaced.  The order depends on ids and
    seed only, so reruns agree.
    """
    kept = [c for c in docs.columns if c not in ("mix_shard", "mix_copy")]
    packed = docs.select("doc_id", "source", "text", F.struct(*kept).alias("row"))
    rows = plan_mix(packed, shards, cap, seed).select(
        "row", "doc_id", "size", F.posexplode("places").alias("mix_copy", "mix_shard"))
    return shuffled(rows, shards, seed, lane_bytes).select("row.*", "mix_shard", "mix_copy")


def shuffled(rows: DataFrame, shards: int, seed: int, lane_bytes: int) -> DataFrame:
    """Rows of a shard together (a large shard in several lanes), in random order."""
    hashed = F.xxhash64(F.lit(seed), "doc_id", "mix_copy")
    lanes = max(1, math.ceil((rows.agg(F.sum("size")).first()[0] or 0) * WORD_BYTES
                             / shards / lane_bytes))
    return (rows.withColumn("order__", hashed)
            .repartition("mix_shard", F.pmod(F.col("order__"), F.lit(lanes)))
            .sortWithinPartitions("mix_shard", "order__"))
