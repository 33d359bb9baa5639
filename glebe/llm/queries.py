"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from glebe.llm import chat_format, collocations, decontaminate, exact_dedup, language_id, line_dedup, mixing, oracle, quality, sharding, simhash, url_filter, vector_codes, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_mix_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(_table(spark, sf_dir, "documents"))


def op5_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op6_bloom_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op7_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copy_components(_table(spark, sf_dir, "documents"))


def op8_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op9_suffix_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated_lines(_table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digests(chat_format.format_texts(rows.unionByName(chat_format.hostile_conversation(spark))))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_template_decontamination, op3_quality_cnn, op4_mix_curriculum, op5_rendezvous_shards, op6_bloom_exact_dedup, op7_simhash_components,
        op8_warc_roundtrip, op9_suffix_line_dedup, op10_url_filter, op11_chat_format, op12_collocations, op13_vector_codes,
    )
}

SQL: dict[str, str] = {k: v for k, v in oracle.SQL.items() if k in QUERIES}
