"""The ways beyond a size bound give the same rows, and a group that holds most rows changes nothing."""

import duckdb
import pytest
from pyspark.sql import functions as F

from brute import deleted_lines
from glebe.llm import decontaminate, exact_dedup, line_dedup, mixing, offsets, queries, sharding, simhash
from llm_cases import SF


def rows_equal_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[key](spark, SF)
    columns = sorted(df.columns)
    cursor = con.execute(queries.SQL[key])
    names = [d[0] for d in cursor.description]
    want = sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == want


@pytest.mark.parametrize("key", ["op4_mix_curriculum", "op5_rendezvous_shards"])
def test_groups_cut_into_many_buckets(spark, monkeypatch, key):
    monkeypatch.setattr(offsets, "BUCKET_ROWS", 1)
    rows_equal_sql(spark, key)


@pytest.fixture()
def no_broadcast(spark, monkeypatch):
    for module in (decontaminate, mixing):
        monkeypatch.setattr(module, "bounded_broadcast", lambda df, *_: df)
    monkeypatch.setattr(exact_dedup, "BROADCAST_BLOCKS", 0)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("key", ["op4_mix_curriculum", "op6_bloom_exact_dedup"])
def test_without_broadcasts(spark, no_broadcast, key):
    rows_equal_sql(spark, key)


def test_decontamination_without_broadcasts(spark, no_broadcast):
    want = duckdb.sql(f"select d.doc_id, b.item_id from '{SF}/documents.parquet' d, '{SF}/benchmark.parquet' b where contains(d.text, b.text)").fetchall()
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op2_template_decontamination"](spark, SF).collect()}
    assert set(want) <= got


@pytest.mark.parametrize("cells_per_row", [exact_dedup.CELLS_PER_ROW, 1])
def test_bloom_filter_lets_every_copy_through_and_few_others(spark, monkeypatch, cells_per_row):
    monkeypatch.setattr(exact_dedup, "CELLS_PER_ROW", cells_per_row)
    hashes = exact_dedup.staged(spark.range(40_000).select(F.xxhash64(F.when(F.col("id") < 300, F.col("id") % 100).otherwise(F.col("id"))).alias("_hash")), "test")
    marked = exact_dedup.maybe_repeated(hashes).groupBy("_hash").agg(F.count(F.lit(1)).alias("n"), F.bool_or("_maybe").alias("maybe")).collect()
    assert all(r.maybe for r in marked if r.n > 1) and sum(r.n > 1 for r in marked) == 100
    if cells_per_row > 1:
        assert sum(r.maybe for r in marked if r.n == 1) < 0.05 * len(marked)


@pytest.fixture(scope="module")
def crowded(spark):
    """2,000 copies of one text in two letter cases, under one source, and some others."""
    text = "\n".join(" ".join(f"w{i}x{j}" for j in range(12)) for i in range(6))
    one = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit(text)).otherwise(F.lit(text.upper())).alias("text"), F.lit("hot").alias("source"))
    rest = spark.range(2000, 2200).select(F.col("id").alias("doc_id"), F.concat(F.lit("own text "), F.col("id"), F.lit(" "), F.sha2(F.col("id").cast("string"), 256)).alias("text"),
                                          F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    return one.unionByName(rest).repartition(8).cache()


def test_hot_group_of_copies(spark, crowded):
    exact = {r.doc_id: r for r in exact_dedup.exact_groups(crowded).collect()}
    assert {(r.keep_id, r.group_size) for i, r in exact.items() if i < 2000} == {(1999, 2000)}
    assert [i for i, r in exact.items() if i < 2000 and r.kept] == [1999]
    assert all(r.kept and r.group_size == 1 and r.keep_id == i for i, r in exact.items() if i >= 2000)
    near = {r.doc_id: r.component_id for r in simhash.near_copy_components(crowded).collect()}
    assert {near[i] for i in range(2000)} == {0} and len(near) == 2200


def test_hot_group_of_lines(spark, crowded):
    texts = [r.text for r in crowded.orderBy("doc_id").collect()]
    gone = deleted_lines(texts, line_dedup.MIN_WORDS)
    got = {r.doc_id: r.removed_lines for r in line_dedup.deduplicated_lines(crowded).collect()}
    assert got == {i: len(gone[i]) for i in range(len(texts))} and sum(got.values()) == 1998 * 6


def test_hot_source_and_one_key(spark, crowded):
    mixed = mixing.mix_documents(crowded).collect()
    taken = {}
    for r in mixed:
        taken.setdefault(round(r.target), 0)
        taken[round(r.target)] += r.taken
    hot = max(taken)
    assert abs(taken[hot] - hot) <= 72  # half of one document
    same_key = crowded.withColumn("doc_id", F.lit(None).cast("long"))
    slots = sharding.shard_documents(same_key).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("low"), F.max("slot").alias("high"), F.count_distinct("slot").alias("d")).collect()
    assert [(r.n, r.low, r.high, r.d) for r in slots] == [(2200, 0, 2199, 2200)]
