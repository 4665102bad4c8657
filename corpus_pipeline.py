"""Training-data pipeline over ``documents``.

Language ID, near-dedup, benchmark decontamination, mixing to target weights
and sharding.  Every stage works on all rows its predecessor kept; its result
is written as Parquet to the shared checkpoint folder and read again by the
next one.  The first four return the columns of ``documents``; the last adds
``size, text_crc32, shard, slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickwin.llm import decontaminate, language_id, mixing, near_dedup, sharding
from clickwin.session import materialize

SHARDS = 40


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no known language: ``und``, or not
    familiar in the language that comes nearest."""
    model = language_id.fit(docs)
    if model is None:           # no labelled row to learn from: nothing can be rejected
        return docs
    predicted = language_id.predict(docs, model, tuple(docs.columns), reject=True)
    return predicted.where("lang_pred <> 'und'").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of near copies."""
    return near_dedup.near_dedup(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of ``benchmark``."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
                                       every_item=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them, shuffled within output shards."""
    return mixing.mix(docs).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of equal bytes, rows numbered."""
    return sharding.shard_documents(docs, SHARDS)


STAGES = [("language_id", identify_language), ("near_dedup", drop_near_copies),
          ("decontamination", drop_leaks), ("mixing", mix_sources), ("sharding", shard)]

ORACLE_SQL = None           # kernels, alignments and draws are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
