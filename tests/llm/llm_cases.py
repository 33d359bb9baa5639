"""Inputs shared by the tests of this folder; the session comes from the conftest above."""

import pytest

SF = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and extra columns whose names clash."""
    long_text = " ".join(f"word{i % 997}" for i in range(60_000))
    rows = [
        (1, None, "en", "a", 0), (2, "", None, None, None), (3, " \t\n ", "en", "a", 3), (4, long_text, "de", "b", len(long_text)),
        (5, "The same line of text", "en", "a", 21), (6, "tHE SAME line of text", "en", "b", 21), (7, "The same line of text", None, "c", 21),
        (8, "one", "fr", "c", 3), (8, "one", "fr", "c", 3), (None, "no id here", "fr", None, 10), (None, None, None, None, None),
        (9, "Ünïcode É text, 12345 !!", "de", "b", 24), (10, "12345 67890", "en", "", 11), (None, "no id here", "fr", None, 10),
    ]
    fields = [(*r, 7, "x", 1.5, True, "y", 3) for r in rows]
    extra = ", _row int, size string, `text 2` double, copies boolean, shard string, position int"
    return spark.createDataFrame(fields, DOCUMENT + extra)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENT)


def as_bag(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
