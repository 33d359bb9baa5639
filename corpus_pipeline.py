"""The corpus pipeline: language ID, near-dedup, decontamination, mixing and sharding of ``documents``.

Every stage is one of the operators of :mod:`glebe.llm`, works on all that the stage before it kept, and is
written as Parquet in the shared scratch folder before the next one reads it, so a lost executor repeats
a stage's task and never the pipeline. All stages but the last return the columns of ``documents``; the last
adds ``shard`` and ``slot``. What a stage does with nulls, ties, repeated rows and empty tables stands in the
docstring of its operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glebe.llm import decontaminate, language_id, mixing, sharding, simhash
from glebe.llm.staging import staged


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a clear language go."""
    return language_id.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays."""
    return simhash.drop_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix takes, in training order."""
    return mixing.curriculum(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row; the slots of a shard follow the training order that the stage before wrote."""
    return sharding.sharded(docs)


STAGES = [
    ("language id", identify_language),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing sources", mix_sources),
    ("sharding", assign_shards),
]

# Compression and XXH64 fingerprints are out of SQL's reach; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
