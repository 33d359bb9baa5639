"""op8 reads records whose header is longer than what is looked at first, and counts what it read."""

import base64
import random

import pytest
from pyarrow import fs

from glebe.llm import warc
from glebe.llm.staging import staged
from glebe.session import scratch_path


def long_url(n):
    return "http://a/?q=" + base64.b64encode(random.Random(n).randbytes(n)).decode()[:n]


def test_long_headers_are_read(tmp_path):
    urls = ["http://a/", long_url(100_000), long_url(3_000_000), "http://b/"]
    path = f"{tmp_path}/x.warc.gz"
    with open(path, "wb") as out:
        out.writelines(warc.encode(i, i, u, b"<p>" * 9, None) for i, u in enumerate(urls))
    with fs.LocalFileSystem().open_input_file(path) as source:
        read = [(warc.page_of(f["warc-record-id"]), f["warc-target-uri"]) for _, f, _ in warc.records_in(source, 0, source.size())]
    assert read == list(enumerate(urls))


def test_round_trip_counts_its_records(spark):
    rows = [(1, long_url(100_000), "<p>A"), (2, "http://b/", "<p>A"), (3, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()}
    assert got == {(1, "response", None), (2, "revisit", 1), (3, "response", None)}
    manifest = warc.write_archives(pages, scratch_path(spark, "test-warc-count"))
    records = staged(warc.read_archives(manifest), "test-warc-records")
    assert warc.counted(records, manifest).count() == 3
    with pytest.raises(ValueError, match="records"):
        warc.counted(records.where("page_id <> 1"), manifest)
