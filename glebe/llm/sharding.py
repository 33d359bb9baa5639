"""Sharding: rendezvous hashing of stable record keys over weighted shards.

For every record and shard, a uniform number ``u`` is drawn from the MD5 of
``key:shard`` and the shard with the largest ``-weight / ln(u)`` takes the
record. The choice depends on the key and on the shards alone, so one more
shard takes records only into itself, and a shard that leaves gives up only its
own records; a weight of 2 draws twice the records of a weight of 1.

Defined results:
  null key          hashed as one constant: all null keys share a shard
  null/empty text   size 1 (0 bytes plus 1), CRC-32 0
  repeated rows     same key, same shard; each row gets its own slot
  empty table       empty result
  extra columns     :func:`with_shard` and :func:`sharded` keep them and replace those called like the new columns;
                    :func:`shard_documents` reads doc_id and text only
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glebe.llm.offsets import bucket_count, with_running_total
from glebe.llm.staging import HASH52_SPAN, hash52, staged

SHARDS = 8


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Shard 0..len(weights)-1 of ``key`` by weighted rendezvous hashing. Weights must be positive."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive, one per shard")
    candidates = []
    for shard, weight in enumerate(weights):
        u = (hash52(key, F.lit(shard)) + F.lit(0.5)) / F.lit(HASH52_SPAN)
        score = F.lit(-float(weight)) / F.log(u)
        candidates.append(F.struct(score.alias("score"), F.lit(shard).alias("shard")))
    best = candidates[0] if len(candidates) == 1 else F.greatest(*candidates)
    return best["shard"]


def with_shard(df: DataFrame, key: str = "doc_id", weights: Sequence[float] = (1.0,) * SHARDS, into: str = "shard") -> DataFrame:
    """``df`` with its shard; no shuffle."""
    return df.withColumn(into, shard_of(F.col(key), weights))


def with_slot(df: DataFrame, slot_key: Column, shard: str = "shard", into: str = "slot") -> DataFrame:
    """Number the rows of every shard from 0 without gaps, in the order of a hash of ``slot_key``.

    A shard is cut into buckets along the hash, so no task sees a whole shard. ``df`` is read three
    times (counts, bucket sums, rows); pass it narrow and staged.
    """
    key = "_slot_key"
    rows = df.withColumn(key, slot_key).withColumn("_h", hash52(F.col(key)))
    most = rows.groupBy(shard).count().agg(bucket_count(F.max("count"))).first()[0] or 1
    width = (1 << 52) // most + 1
    rows = rows.withColumn("_b", F.floor(F.col("_h") / F.lit(width)).cast("long")).withColumn("_one", F.lit(1).cast("long"))
    out = with_running_total(rows, [shard], "_b", [F.col("_h"), F.col(key)], "_one", into)
    return out.drop("_h", "_b", "_one", key)


def write_shards(df: DataFrame, path: str, key: str = "doc_id", weights: Sequence[float] = (1.0,) * SHARDS, files_per_shard: int = 16) -> None:
    """Write ``df`` as Parquet folders ``shard=<n>``; every shard is spread over several tasks and files."""
    sharded = with_shard(df, key, weights)
    spread = F.pmod(hash52(F.col(key), F.lit("file")), F.lit(files_per_shard))
    sharded.repartition(len(weights) * files_per_shard, "shard", spread).write.partitionBy("shard").parquet(path)


def _slot_key(key: str = "doc_id") -> Column:
    """The key, or for null ids (which share one shard) the text's CRC-32 and size, so that many of them spread over buckets."""
    return F.coalesce(F.col(key).cast("string"), F.concat_ws(":", F.lit("~"), "text_crc32", "size"))


def _measures(text: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    return {"size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text.cast("binary")).cast("long")}


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (the shard with one more)."""
    rows = docs.select(
        "doc_id",
        *[c.alias(name) for name, c in _measures(F.col("text")).items()],
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), (1.0,) * shards).alias("shard"),
        shard_of(F.col("doc_id"), (1.0,) * (shards + 1)).alias("grown_shard"),
    )
    return with_slot(staged(rows, "shards"), _slot_key()).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _place(docs: DataFrame) -> dict[str, Column]:
    """File and row at which a table's rows stand, where the table is read from files; else nothing."""
    try:
        meta = docs.metadataColumn("_metadata")
        place = {"_file": meta["file_name"], "_index": meta["row_index"]}
        docs.select(*[c.alias(n) for n, c in place.items()]).schema  # not every table has them
        return place
    except AnalysisException:
        return {}


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All columns of ``docs``, then its shard and slot (columns of these names are replaced); the rows of a shard lie together.

    Rows read from files keep their order inside a shard: slots follow the names of the files and the rows in them, as a
    range sort before has written them. Rows of other tables are numbered in the order of a hash."""
    place = _place(docs)
    kept = [docs[f"`{c}`"] for c in docs.columns if c not in ("shard", "slot")]
    rows = docs.select(F.struct(*kept).alias("_row"), F.col("doc_id").alias("doc_id"), shard_of(F.col("doc_id"), (1.0,) * shards).alias("shard"),
                       *[c.alias(n) for n, c in {**_measures(F.col("text")), **place}.items()])
    if not place:
        return with_slot(rows, _slot_key()).select("_row.*", "shard", "slot")
    rows = rows.withColumn("_one", F.lit(1).cast("long"))
    return with_running_total(rows, ["shard"], "_file", [F.col("_index")], "_one", "slot", sums_of=rows.drop("_row")).select("_row.*", "shard", "slot")
