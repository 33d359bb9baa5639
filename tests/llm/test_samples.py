"""Samples of labelled rows when ids repeat, many languages, and the training order through the pipeline's last stages."""

from pyspark.sql import functions as F

import corpus_pipeline
from glebe.llm import language_id, mixing, quality, sharding, warc
from glebe.llm.samples import per_label
from glebe.llm.staging import staged
from llm_cases import SF


def test_labels_of_one_shared_id_are_learned(spark):
    for shared in (13, 14, 18):  # none of them held out
        german = spark.range(900).select(F.lit(shared).cast("long").alias("doc_id"), F.lit("der hund und die katze laufen durch den wald").alias("text"), F.lit("de").alias("lang"))
        english = spark.range(400).select((F.col("id") + 1000).alias("doc_id"), F.concat(F.lit("the dog and the cat run through the wood "), "id").alias("text"), F.lit("en").alias("lang"))
        model = language_id.fit(german.unionByName(english))
        assert [lang for lang, _ in model] == ["de", "en"]


def test_many_languages(spark):
    docs = spark.range(820).select(F.col("id").alias("doc_id"), F.concat(F.lit("word"), F.col("id") % 205).alias("text"), F.concat(F.lit("l"), F.col("id") % 205).alias("lang"))
    got = language_id.identify(docs)
    assert got.count() == 820 and len(language_id.fit(docs)) == docs.where(language_id.crc_bucket(F.col("doc_id"), 4) != 2).select("lang").distinct().count()


def test_samples_are_full(spark):
    rows = spark.range(5_000).select((F.col("id") % 3).cast("string").alias("label"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("key"))
    rows = rows.unionByName(spark.createDataFrame([("few", 1), ("few", 1), (None, 5)], "label string, key long"))
    got = {r.label: r["count"] for r in per_label(rows, "label", ["key"], 40).groupBy("label").count().collect()}
    assert got == {"0": 40, "1": 40, "2": 40, "few": 2}


def test_quality_with_repeated_documents(spark):
    docs = spark.range(300).select((F.col("id") % 10).alias("doc_id"), F.lit("some text").alias("text"))
    labels = spark.range(400).select((F.col("id") % 10).alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    assert quality.score_documents(docs, labels).count() == 300


def test_ranges_follow_the_size_of_the_archives():
    assert warc.range_bytes(0) == warc.range_bytes(10**9) == warc.SPLIT_BYTES
    assert warc.range_bytes(10**12) == 10**8 and warc.range_bytes(10**14) == warc.LARGEST_SPLIT


def test_slots_follow_the_training_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = staged(corpus_pipeline.mix_sources(spark, docs, SF), "test-mix")
    out = sharding.sharded(mixed).collect()
    due = {r.doc_id: r.position for r in mixing.mix_documents(docs).collect()}
    for s in range(sharding.SHARDS):
        rows = sorted((r for r in out if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in rows] == list(range(len(rows)))
        first = {}
        for r in rows:
            first.setdefault(r.doc_id, r.slot)
        places = [due[i] for i, _ in sorted(first.items(), key=lambda x: x[1])]
        assert places == sorted(places)
    assert len(out) == mixed.count()
