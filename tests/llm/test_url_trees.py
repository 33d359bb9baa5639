"""op10's trees on rows hidden from training."""

import math

from pyspark.sql import functions as F

from glebe.llm import url_filter
from glebe.llm.staging import staged

PAGES = "/root/testdata/sf0.01/pages.parquet"


def test_trees_on_hidden_rows(spark):
    rows = staged(url_filter.parsed(spark.read.parquet(PAGES)).where("ruled is not null").withColumn("hidden", F.pmod(F.xxhash64("url"), F.lit(5)) == 0), "test")
    model = url_filter.fit(rows.where("not hidden").drop("hidden"))
    got = url_filter.scored(rows.where("hidden"), model).select("ruled", "score").collect()
    right = [(r.score >= url_filter.BLOCK_FROM) == (r.ruled == "block") for r in got]
    blocked = [r.score >= url_filter.BLOCK_FROM for r in got if r.ruled == "block"]
    assert len(got) > 25 and sum(right) / len(right) > 0.9 and sum(blocked) / len(blocked) > 0.8


def test_entropy(spark):
    texts = ["", "a", "ab", "aab", "\u00e9\u00e9x", "0123456789" * 3_000]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", url_filter._entropy(F.col("t")).alias("e")).collect()
    for r in got:
        shares = [r.t.count(c) / len(r.t) for c in set(r.t)]
        assert abs(r.e - -sum(p * math.log2(p) for p in shares)) < 1e-9
