"""Bounded, repeatable samples of labelled rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glebe.llm.staging import HASH52_SPAN, hash52, staged
from glebe.operators.broadcast import bounded_broadcast


def per_label(rows: DataFrame, label: str, keys: list[str], most: int) -> DataFrame:
    """At most ``most`` rows of each label, those with the smallest hashes of ``keys``; all rows of a label that has fewer.

    The labels are counted first; a hash threshold then keeps about twice ``most`` rows of each before
    the rank, so that a frequent label never meets in one task as a whole. The rank is limited map-side.
    Rows that are equal in all keys share a hash, so many of them may fall beyond the threshold together: a label
    that got fewer rows than it has to is ranked again without it, limited map-side to ``most`` rows of a task.
    """
    counts = staged(rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n")), "labels")
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_h", *keys))
    hashed = rows.withColumn("_h", hash52(*[F.col(k) for k in keys], F.lit("sample")))
    part = F.lit(2.0 * most + 100) / F.col("_n") * F.lit(HASH52_SPAN)
    near = hashed.join(bounded_broadcast(counts), label).where(F.col("_h") < part).drop("_n")
    picked = staged(near.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank", "_h"), "sample")
    got = picked.groupBy(label).agg(F.count(F.lit(1)).alias("_got"))
    short = counts.join(got, label, "left").where(F.coalesce("_got", F.lit(0)) < F.least(F.col("_n"), F.lit(most))).select(label)
    short = staged(short, "short-labels")
    if short.isEmpty():
        return picked
    again = hashed.join(bounded_broadcast(short), label, "left_semi").withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank", "_h")
    return picked.join(bounded_broadcast(short), label, "left_anti").unionByName(staged(again, "sample"))
