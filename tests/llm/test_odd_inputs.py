"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names: defined results."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brute import ascii_lower, shard, simhash

from glebe.llm import decontaminate, exact_dedup, language_id, line_dedup, mixing, quality, sharding, simhash as sh, url_filter, warc
from llm_cases import as_bag, no_documents, odd_documents  # noqa: F401



def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_language_id(spark, odd_documents, no_documents):
    got = rows_of(language_id.identify(odd_documents))
    assert len(got) == 14
    texts = {r.doc_id: r.text for r in odd_documents.collect() if r.doc_id is not None}
    for r in got:
        text = texts.get(r["doc_id"], "no id here")
        if r["doc_id"] is not None and not any(c.isalpha() for c in text or ""):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in {"en", "de", "fr"}
        assert 0 <= r["score"] <= 1
    assert language_id.identify(no_documents).count() == 0
    kept = language_id.keep_identified(odd_documents)
    assert kept.columns == odd_documents.columns and kept.where("text is null").count() == 0
    unlabelled = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in rows_of(language_id.identify(unlabelled))} == {"und"}
    assert language_id.keep_identified(no_documents).columns == no_documents.columns


def test_quality(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(None, 1, 1), (3, None, 0), (999, 0, 0)], "doc_id long, quality int, toxic int")
    got = rows_of(quality.score_documents(odd_documents, labels))
    assert len(got) == 14 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    one = labels.where("quality = 1")
    assert {r["score"] for r in rows_of(quality.score_documents(odd_documents, one))} == {1.0}
    assert {r["score"] for r in rows_of(quality.score_documents(odd_documents, labels.limit(0)))} == {0.5}
    assert quality.score_documents(no_documents, labels).count() == 0


def test_mixing(spark, odd_documents, no_documents):
    got = rows_of(mixing.mix_documents(odd_documents))
    assert len(got) == 14
    assert sum(r["taken"] for r in got) <= 1.6 * sum(r["size"] for r in got)
    for r in got:
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        assert (r["position"] is None) == (r["copies"] == 0)
    assert {r["size"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    assert mixing.mix_documents(no_documents).count() == 0
    copies = mixing.curriculum(odd_documents)
    assert copies.columns == odd_documents.columns and copies.count() == sum(r["copies"] for r in got)
    assert mixing.curriculum(no_documents).columns == no_documents.columns


def test_sharding(spark, odd_documents, no_documents):
    got = rows_of(sharding.shard_documents(odd_documents))
    assert len(got) == 14
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert r["shard"] == shard(r["doc_id"], (1.0,) * 8) and r["grown_shard"] in (r["shard"], 8)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert {r["size"] for r in got if r["doc_id"] in (1, 2)} == {1}
    whole = sharding.sharded(odd_documents)
    assert whole.columns == [c for c in odd_documents.columns if c != "shard"] + ["shard", "slot"] and whole.count() == 14
    assert sharding.shard_documents(no_documents).count() == 0 and sharding.sharded(no_documents).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("doc_id"), [1.0, 0.0])


def test_exact_dedup(spark, odd_documents, no_documents):
    got = rows_of(exact_dedup.exact_groups(odd_documents))
    assert len(got) == 14
    groups = {}
    for r, text in [(r.doc_id, r.text) for r in odd_documents.collect()]:
        groups.setdefault(hashlib.sha256(ascii_lower(text).encode()).hexdigest(), []).append(r)
    for r in got:
        ids = groups[r["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids) and r["keep_id"] == (max(known) if known else None)
    kept = {}
    for r in got:
        kept[r["text_sha256"]] = kept.get(r["text_sha256"], 0) + r["kept"]
    assert set(kept.values()) == {1}  # repeated rows and null ids too
    assert exact_dedup.exact_groups(no_documents).count() == 0
    left = exact_dedup.drop_copies(odd_documents)
    assert left.columns == odd_documents.columns and left.count() == len(groups)


def test_simhash(spark, odd_documents, no_documents):
    got = rows_of(sh.near_copy_components(odd_documents))
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for r in odd_documents.where("doc_id is not null").collect():
        assert by_id[r.doc_id]["fingerprint"] == f"{simhash(r.text):016x}"
    assert [by_id[i]["component_id"] for i in (1, 2, 3)] == [1, 1, 1]
    assert [by_id[i]["component_id"] for i in (5, 6, 7)] == [5, 5, 5]
    assert sum(r["component_id"] is None for r in got) == 2  # the two null ids with a text of their own
    assert sh.near_copy_components(no_documents).count() == 0
    left = sh.drop_near_copies(odd_documents)
    assert left.columns == odd_documents.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 4, 5, 8, 9, 10]
    assert left.where("doc_id is null").count() == 1


def test_warc(spark):
    schema = "page_id long, url string, html string, payload string, path int, extra int"
    big = "<p>" + "x" * 2_000_000
    rows = [
        (3, "http://a/", "<p>A", "?", 1, 1), (1, "http://b/", "<p>A", "?", 1, 1), (2, None, None, "?", 1, 1), (5, "u\r\nWARC-Type: x", "", "?", 1, 1),
        (None, "n", "<p>A", "?", 1, 1), (None, "n", "<p>only", "?", 1, 1), (7, "é", big, "?", 1, 1), (7, "é", big, "?", 1, 1), (8, "x", "\x1f\u008b\b WARC/1.1", "?", 1, 1),
    ]
    got = as_bag(warc.round_trip(spark.createDataFrame(rows, schema)), "page_id", "payload_bytes", "record_type", "refers_to")
    assert got == sorted([
        (1, 4, "response", None), (3, 4, "revisit", 1), (None, 4, "revisit", 1), (2, 0, "response", None), (5, 0, "revisit", 2),
        (None, 7, "response", None), (7, 2_000_003, "response", None), (7, 2_000_003, "revisit", 7), (8, 13, "response", None),
    ], key=repr)
    assert warc.round_trip(spark.createDataFrame([], schema)).count() == 0


def test_url_filter(spark):
    schema = "page_id long, url string, html string, host int, label int"
    rows = [
        (1, None, None, 1, 1), (2, "no scheme/en/", None, 1, 1), (3, "HTTP://WWW.Example.COM/en/x?q#f", None, 1, 1), (4, "http://a.example.com/en/", None, 1, 1),
        (5, "http://com/", None, 1, 1), (6, "http://b.com", None, 1, 1), (7, "http://x.net/fr/1", None, 1, 1), (7, "http://x.net/fr/1", None, 1, 1),
        (None, "http://ünï.org/" + "a/" * 20_000, None, 1, 1), (9, "", None, 1, 1), (10, "http://notcom/x", None, 1, 1), (11, "a://b://c.com/d?://", None, 1, 1),
    ]
    got = {r["page_id"]: r for r in rows_of(url_filter.judge(spark.createDataFrame(rows, schema)))}
    said = {k: (r["host"], r["path"][:6], r["rule"]) for k, r in got.items()}
    assert said == {
        1: ("", "", None), 2: ("", "", None), 3: ("www.example.com", "/en/x", "www.example.com/en/"), 4: ("a.example.com", "/en/", "example.com/en/"),
        5: ("com", "/", "com/"), 6: ("b.com", "", None), 7: ("x.net", "/fr/1", "net/fr/"), None: ("ünï.org", "/a/a/a", None), 9: ("", "", None),
        10: ("notcom", "/x", None), 11: ("b:", "//c.co", None),
    }
    assert (got[3]["verdict"], got[4]["verdict"], got[5]["verdict"], got[7]["verdict"]) == ("allow", "block", "allow", "block")
    assert all(r["verdict"] in ("allow", "block") for r in got.values())
    unlabelled = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(unlabelled).collect()] == ["allow"]
    assert url_filter.judge(spark.createDataFrame([], schema)).count() == 0


def test_decontamination(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (4, "the same line of text"), (4, "the same line of text"), (None, "no id here")], "item_id long, text string")
    found = as_bag(decontaminate.contaminated_documents(odd_documents, items), "doc_id", "item_id")
    assert set(found) == {(5, 4), (6, 4), (7, 4), (8, 3), (None, None)}
    assert decontaminate.contaminated_documents(no_documents, items).count() == 0
    assert decontaminate.contaminated_documents(odd_documents, items.limit(0)).count() == 0
    left = decontaminate.drop_contaminated(odd_documents, items)
    assert left.columns == odd_documents.columns and left.count() == 14 - 3 - 2 - 2
    assert decontaminate.drop_contaminated(odd_documents, items.limit(0)).count() == 14


def test_line_dedup(spark, odd_documents, no_documents):
    got = rows_of(line_dedup.deduplicated_lines(odd_documents))
    assert len(got) == 14 and sum(r["removed_lines"] for r in got) == 0
    assert line_dedup.deduplicated_lines(no_documents).count() == 0
    run = "\n".join(" ".join(f"w{i}{j}" for j in range(9)) for i in range(8))
    docs = spark.createDataFrame([(2, f"own two\n{run}\n \nend", 1), (1, f"{run}\n", 1), (None, None, 1), (3, run, 1), (3, run, 1)], "doc_id long, text string, runs int")
    left = line_dedup.drop_repeated_lines(docs)
    assert left.columns == docs.columns
    assert as_bag(left, "doc_id", "text") == sorted([(2, "own two\n \nend"), (1, f"{run}\n"), (None, None), (3, ""), (3, "")], key=repr)


def test_pipeline_on_odd_and_empty_tables(spark, odd_documents, no_documents, tmp_path):
    bench = spark.createDataFrame([(1, "some other benchmark text that nobody holds")], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd_documents, no_documents):
        out = docs
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, str(tmp_path))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns, name
        assert out.columns[-2:] == ["shard", "slot"] and out.count() >= 0
