"""From raw documents to a sharded training set, a table per stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm import decontamination, jaccard_join, mixing, quality, sharding
from pressmill.llm._common import materialise, release, table

#: Near duplicates of the pipeline: shingles of five words, Jaccard similarity of 0.8 or more.
DEDUP_WORDS, DEDUP_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the cascade."""
    return quality.filter_docs(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents."""
    return jaccard_join.dedup(docs, DEDUP_WORDS, DEDUP_PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages: long or dense hits drop the document, short ones are cut out."""
    return decontamination.remove(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def hilbert_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot, neighbours in source, language and size together."""
    dimensions = [F.col("source"), F.col("lang"), sharding.text_size(F.col("text"))]
    return sharding.shard(docs, dimensions, [F.crc32(F.coalesce("text", F.lit(""))), F.col("doc_id")])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mixing", source_mixing),
    ("hilbert sharding", hilbert_sharding),
]

#: Components and balanced samples are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES:
        after = materialise(stage(spark, docs, sf_dir))
        if before is not None:
            release(before)
        docs = before = after
    return docs
