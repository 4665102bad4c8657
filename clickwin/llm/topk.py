"""Exact top-k search with block-at-a-time pruning (operator 10).

Vectors are read as weighted terms (one per component).  Consecutive rows
form blocks; a block keeps its rows (the forward index) and each term's
extremes.  For a query the sum over its terms of the larger of ``q * max``
and ``q * min`` bounds every score in the block.  Each task orders its blocks
by that bound, per query, and scores block after block as one matrix product
with the queries that are due for it, until the bound falls below the query's
k-th score; a bound equal to it is still scored, so ties stay exact.  The
tasks' best ``k`` are merged by a window whose partial limit ships ``k`` rows
per query and task.

Queries are broadcast in slices of at most QUERIES rows, each of which passes
the table once; there is no cross join and no candidate is left out.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickwin.llm.common import batch_of

BLOCK = 256
QUERIES = 1 << 16


def usable(vector: Column) -> Column:
    """Neither null nor holding a null or non-finite component."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                                         & (F.abs(x) < float("inf")))


def integers(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """floor(256 * x) of every vector, as doubles (exact up to 2^53); shorter
    vectors are continued with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    wide = max(int(sizes.max(initial=0)), width or 0)
    flat = np.floor(256 * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(sizes) and sizes.min() == wide:
        return flat.reshape(len(sizes), wide)
    out = np.zeros((len(sizes), wide))
    out[np.arange(wide) < sizes[:, None]] = flat
    return out


class Best:
    """The k best (score, id) of every query so far; ties to smaller ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.up, self.down = np.maximum(vectors, 0), np.minimum(vectors, 0)
        self.score = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.scored = 0             # (query, block) products made, of all

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        """Look through rows of the table."""
        blocks = []
        for at in range(0, len(ids), BLOCK):
            order = at + np.argsort(ids[at:at + BLOCK], kind="stable")
            blocks.append((ids[order], rows[order]))
        bound = (self.up @ np.array([b.max(0) for _, b in blocks]).T
                 + self.down @ np.array([b.min(0) for _, b in blocks]).T)
        order = np.argsort(-bound, axis=1, kind="stable")
        due = np.arange(len(self.ids))
        for turn in range(len(blocks)):
            block = order[due, turn]
            due = due[bound[due, block] >= self.score[due, -1]]
            if not len(due):
                break
            block = order[due, turn]
            self.scored += len(due)
            for b in np.unique(block):
                self._score(due[block == b], *blocks[b])

    def _score(self, q: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        score = self.vectors[q] @ rows.T
        score[self.ids[q][:, None] == ids[None, :]] = -np.inf        # the query's own row
        hit = (score >= self.score[q, -1:]).any(1) & (score > -np.inf).any(1)
        q, score = q[hit], score[hit]
        top = np.argsort(-score, axis=1, kind="stable")[:, :self.k]
        best = np.take_along_axis(score, top, 1)
        new = np.where(np.isinf(best), np.iinfo(np.int64).max, ids[top])
        score = np.hstack([self.score[q], best])
        found = np.hstack([self.found[q], new])
        order = np.lexsort((found, -score))[:, :self.k]
        self.score[q] = np.take_along_axis(score, order, 1)
        self.found[q] = np.take_along_axis(found, order, 1)


def top_k(table: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "embedding", per_pass: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest integer
    inner products over all other rows (all, if fewer), ties to the smaller id.

    Vectors that are null or hold a null, NaN or infinite component, and rows
    with a null id, take no part; vectors of other lengths are continued with
    zeros.  A query is left out of its own answer by id; of query rows with
    equal ids one is answered, repeated table rows are candidates each.  A
    query without candidates, and empty tables, give no rows.  Other columns
    are not read.
    """
    spark = table.sparkSession
    ok = usable(F.col(vector_col)) & F.col(id_col).isNotNull()
    rows = table.where(ok).select(F.col(id_col).cast("bigint").alias("i"),
                                  F.col(vector_col).alias("v"))
    asked = (queries.where(ok).select(F.col(id_col).cast("bigint").alias("i"),
                                      F.col(vector_col).alias("v"))
             .groupBy("i").agg(F.min("v").alias("v")))
    number = queries.where(ok).count()
    passes = max(1, math.ceil(number / (0.8 * per_pass)))
    parts = [_one_pass(spark, rows, asked if passes == 1 else asked.where(
        F.pmod(F.xxhash64("i"), F.lit(passes)) == p), k) for p in range(passes)]
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (reduce(DataFrame.unionByName, parts)
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _one_pass(spark, rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    got = asked.toArrow().combine_chunks()
    ids = got.column("i").to_numpy()
    lists = got.column("v").combine_chunks()
    vectors = integers(lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists) \
        if len(ids) else np.zeros((0, 1))
    shared = spark.sparkContext.broadcast((ids, vectors))    # at most per_pass rows
    schema = "query_id bigint, vec_id bigint, score bigint"
    arrow = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        ids, vectors = shared.value
        if not len(ids):
            return
        best = Best(ids, vectors, k)
        for batch in batches:
            if batch.num_rows:
                data = integers(batch.column("v"), best.vectors.shape[1])
                wide = data.shape[1] - best.vectors.shape[1]
                if wide > 0:
                    for name in ("vectors", "up", "down"):
                        setattr(best, name, np.pad(getattr(best, name), ((0, 0), (0, wide))))
                best.add(batch.column("i").to_numpy(), data)
        q, at = np.nonzero(best.score > -np.inf)
        yield batch_of(arrow, ids[q], best.found[q, at], best.score[q, at].astype(np.int64))

    return rows.mapInArrow(run, schema)
