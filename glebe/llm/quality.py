"""Quality classifier: the byte-level convolutional network of :mod:`glebe.llm.byte_cnn` over Spark.

Fitted on at most :data:`SAMPLE_DOCS` labelled documents of each label, each given by
:data:`SAMPLE_CHUNKS` slices spread over its whole length; every text is scored from all of its chunks.

Defined results:
  null text            scored as the empty text (one chunk of padding)
  very long text       scored in blocks of chunks, bounded memory
  no labels, or labels of one kind only   score 0.5 or that label
  repeated labels      a (doc_id, quality) pair counts once, with the first of its texts where several documents share the id;
                       null labels and labels without a document do not count
  null doc_id          hashed like the empty text, never joined to a label
  empty table          empty result
  extra columns        not read
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from glebe.llm import byte_cnn
from glebe.llm.samples import per_label
from glebe.llm.staging import crc_bucket, hash52

SAMPLE_DOCS = 1500
SAMPLE_CHUNKS = 6
STEPS = 700  # of 64 documents
SEED = 7
HELD_OUT = (3, 1)  # crc32(doc_id as text) mod 3 is 1


def _slices(text: Column) -> Column:
    """SAMPLE_CHUNKS slices of CHUNK characters, the first at the start and the last at the end of the text."""
    room = F.greatest(F.char_length(text) - byte_cnn.CHUNK, F.lit(0))
    starts = [F.floor(room * i / (SAMPLE_CHUNKS - 1)).cast("int") + 1 for i in range(SAMPLE_CHUNKS)]
    return F.array(*[F.substring(text, s, F.lit(byte_cnn.CHUNK)) for s in starts])


def fit(docs: DataFrame, labels: DataFrame) -> byte_cnn.ByteCnn | float:
    """The trained network, or a constant score where the labels do not hold both kinds.

    The labels are ranked before they meet the documents, so a sample of ids (bounded, broadcast) picks the texts.
    """
    known = labels.where((crc_bucket(F.col("doc_id"), HELD_OUT[0]) != HELD_OUT[1]) & F.col("doc_id").isNotNull())
    known = known.select("doc_id", F.col("quality").cast("int").alias("quality")).where("quality in (0, 1)")
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    picked = per_label(known, "quality", ["doc_id"], SAMPLE_DOCS)
    texts = docs.select("doc_id", _slices(F.coalesce(F.col("text"), F.lit(""))).alias("slices"))
    # One row for each label of an id, whatever the number of its documents and labels: 2 * SAMPLE_DOCS rows at most.
    sample = texts.join(F.broadcast(picked.distinct()), "doc_id").groupBy("doc_id", "quality").agg(F.min("slices").alias("slices"))
    rows, answers = [], []
    for row in sample.orderBy(hash52(F.col("doc_id")), "doc_id", "quality").toLocalIterator():
        chunk = np.zeros((SAMPLE_CHUNKS, byte_cnn.CHUNK), dtype=np.uint8)
        for i, piece in enumerate(row["slices"]):
            data = piece.encode("utf-8")[: byte_cnn.CHUNK]
            chunk[i, : len(data)] = np.frombuffer(data, dtype=np.uint8)
        rows.append(chunk)
        answers.append(row["quality"])
    if len(set(answers)) < 2:
        return float(answers[0]) if answers else 0.5
    return byte_cnn.train(np.stack(rows), answers, STEPS, SEED)


def scored(text: Column, model: byte_cnn.ByteCnn | float) -> Column:
    @pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if isinstance(model, float):
                yield pd.Series(np.full(len(texts), model))
            else:
                yield pd.Series([model.score((t or "").encode("utf-8")) for t in texts], dtype="float64")

    return of(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    held_out = crc_bucket(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1]
    out = docs.select("doc_id", held_out.alias("held_out"), scored(F.col("text"), fit(docs, labels)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
