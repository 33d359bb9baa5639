"""Language identification by compression.

For every language, up to :data:`SAMPLE_DOCS` slices of :data:`SLICE_CHARS`
characters of labelled texts, lower-cased, make one zstandard raw-content
dictionary. A text is encoded with each dictionary; the language whose
dictionary gives the fewest bytes wins. Long texts are encoded chunk by chunk
(all chunks of the text, each with the whole dictionary in reach) and the sizes
added, so memory stays bounded and a dictionary's help does not fade. Texts
below :data:`SHORT_BYTES` use a slower level that finds shorter matches.

The result is rejected when the margin to the second best is narrow: less than
:data:`MIN_MARGIN` of the best size, or no byte at all.

The model is bounded: all dictionaries together have at most
:data:`FULL_LANGUAGES` * SAMPLE_DOCS * SLICE_CHARS characters. Up to
FULL_LANGUAGES languages get SAMPLE_DOCS slices each; more share them evenly,
a slice each at least, and of more than FULL_LANGUAGES * SAMPLE_DOCS labels the
most frequent are learned.

Defined results:
  null text, text without a letter   ``und``, score 0, rejected
  no labelled text at all            ``und`` for every row
  a single language                  that language, score 1
  ties                               the language with more labelled texts, then by code point; rejected
  null doc_id                        hashed like the empty text
  repeated rows                      each row is judged by itself
  extra columns                      kept by :func:`keep_identified` whatever their names
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from glebe.llm.samples import per_label
from glebe.llm.staging import crc_bucket, hash52, packed, unpacked

SAMPLE_DOCS = 320
SLICE_CHARS = 400
FULL_LANGUAGES = 200
CHUNK_BYTES = 4096
LEVEL = 5
SHORT_BYTES = 1024
SHORT_LEVEL = 12
MIN_MARGIN = 0.003
UNKNOWN = "und"
HELD_OUT = (4, 2)  # crc32(doc_id as text) mod 4 is 2


def fit(docs: DataFrame) -> list[tuple[str, bytes]]:
    """(language, dictionary) of the labelled texts outside the held-out part, the most frequent language first."""
    labelled = docs.where((crc_bucket(F.col("doc_id"), HELD_OUT[0]) != HELD_OUT[1]) & F.col("lang").isNotNull())
    labelled = labelled.where(F.col("text").rlike(r"\p{L}"))
    frequent = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(FULL_LANGUAGES * SAMPLE_DOCS).collect()
    slices = max(1, min(SAMPLE_DOCS, FULL_LANGUAGES * SAMPLE_DOCS // max(1, len(frequent))))
    if len(frequent) == FULL_LANGUAGES * SAMPLE_DOCS:
        labelled = labelled.where(F.col("lang").isin([r["lang"] for r in frequent]))
    # A slice from anywhere in the text, the same on every run.
    room = F.greatest(F.char_length("text") - SLICE_CHARS, F.lit(0))
    start = F.pmod(hash52(F.col("doc_id"), F.lit("slice")), room + 1) + 1
    piece = F.lower(F.substring(F.col("text"), start.cast("int"), F.lit(SLICE_CHARS)))
    sample = per_label(labelled.select("lang", "doc_id", piece.alias("piece")), "lang", ["doc_id", "piece"], slices)
    pieces: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", hash52(F.col("doc_id")), "piece").toLocalIterator():
        pieces.setdefault(row["lang"], []).append(row["piece"])
    return [(r["lang"], "\n".join(pieces[r["lang"]]).encode("utf-8")) for r in frequent if r["lang"] in pieces]


class Encoders:
    """The compressors of one model, made once per task."""

    def __init__(self, model: list[tuple[str, bytes]]):
        self.languages = [lang for lang, _ in model]
        self.long = [self._encoder(data, LEVEL) for _, data in model]
        self.short = [self._encoder(data, SHORT_LEVEL) for _, data in model]

    @staticmethod
    def _encoder(data: bytes, level: int) -> zstandard.ZstdCompressor:
        words = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=level)
        return zstandard.ZstdCompressor(level=level, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False)

    def sizes(self, text: str) -> list[int]:
        data = text.lower().encode("utf-8")
        if len(data) < SHORT_BYTES:
            return [len(e.compress(data)) for e in self.short]
        parts = [data[i:i + CHUNK_BYTES] for i in range(0, len(data), CHUNK_BYTES)]
        return [sum(len(e.compress(p)) for p in parts) for e in self.long]

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin): margin is the second best size over the best, less 1; 0 for a tie."""
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        behind = [s - sizes[best] for i, s in enumerate(sizes) if i != best]
        score = 1.0 / (1.0 + sum(2.0 ** -min(b, 1000) for b in behind))
        return self.languages[best], score, min(behind) / sizes[best] if behind else 1.0


def judged(text: Column, model: list[tuple[str, bytes]]) -> Column:
    """Struct (lang_pred, score, margin) of a text."""

    @pandas_udf("lang_pred string, score double, margin double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoders = Encoders(model)
        for texts in batches:
            yield pd.DataFrame([encoders.judge(t) for t in texts], columns=["lang_pred", "score", "margin"])

    return of(text)


def rejected(judgement: Column) -> Column:
    return (judgement["lang_pred"] == UNKNOWN) | (judgement["margin"] < MIN_MARGIN)


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, margin, rejected."""
    held_out = crc_bucket(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1]
    out = docs.select("doc_id", held_out.alias("held_out"), judged(F.col("text"), fit(docs)).alias("j"))
    return out.select("doc_id", "held_out", "j.lang_pred", "j.score", "j.margin", rejected(F.col("j")).alias("rejected"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that are rejected; all columns unchanged."""
    rows = packed(docs, text=F.col("text")).withColumn("j", judged(F.col("text"), fit(docs)))
    return unpacked(rows.where(~rejected(F.col("j"))))
