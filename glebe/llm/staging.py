"""Written intermediate tables and other helpers shared by the operators.

A staged table lives in a fresh folder below the session's
``spark.checkpoint.dir`` (a shared folder), so a lost executor re-reads it
instead of recomputing, values such as row ids are frozen, and the exchanges of
later joins stand directly on a scan, where AQE can split a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glebe.session import scratch_path

# ASCII white space that separates words; every other code point belongs to a word.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER_ASCII = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_ASCII = "abcdefghijklmnopqrstuvwxyz"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once as Parquet in the shared scratch folder, and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, **helpers: Column) -> DataFrame:
    """All columns of ``df`` in one struct ``_row`` beside helper columns, so that no helper's name can clash."""
    return df.select(F.struct(F.col("*")).alias("_row"), *[c.alias(name) for name, c in helpers.items()])


def unpacked(df: DataFrame) -> DataFrame:
    """The columns that :func:`packed` put away, in their order."""
    return df.select("_row.*")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and every other code point left as it is (``lower`` folds the rest of Unicode too)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER_ASCII, LOWER_ASCII))


def word_count(text: Column) -> Column:
    """Words of ``text`` (runs of anything but ASCII white space); null counts 0. One pass, no array of words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long"), F.lit(0).cast("long"))


def crc_bucket(doc_id: Column, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def hash52(*parts: Column) -> Column:
    """A uniform integer in [0, 2^52) from the first 13 hex digits of the MD5 of the parts joined by ``:``."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


HASH52_SPAN = float(1 << 52)
