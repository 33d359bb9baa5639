"""Incremental ingestion of landing directories with Structured Streaming.

``stream_insert_only``: a stream of newly arrived file names (binaryFile source,
content never read); each micro-batch loads exactly its files with the batch job
(header binding, quarantine, first row per key, anti-join, run-named publish). Progress lives in
the query's ``checkpointLocation`` — files are taken once; a replayed batch is
harmless because the anti-join finds keys already published. Reset (T4) is a
fresh checkpoint location: the table still refuses keys it has.

``stream_first_seen``: each code the first time the stream sees it. Files are bound in the JVM by the batch reader; codes
seen before are found by the sink's key filters, so the query keeps no state of codes at all.

``stream_dedupe``: the same with Spark's state only (``dropDuplicates``), for sinks that cannot be read. The
state grows with the number of distinct keys; use it only for bounded key sets
or with ``dropDuplicatesWithinWatermark`` on keyed events that carry a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glebe.functions import constants as C
from glebe.operators import commits
from glebe.operators import load as L
from glebe.operators import registry as R
from glebe.session import staged
from glebe.sources import landing

# Files of one micro-batch at most; the stream takes all files, oldest first. Bounds the path list of a batch.
MAX_FILES_PER_BATCH = 1_000


def _file_stream(spark: SparkSession, directory: str, max_files: int) -> DataFrame:
    """New ``*.csv`` files of the directory, one row per file: only path metadata is read
    (the binary content column is never selected, so the stream does not load the files)."""
    schema = "path string, modificationTime timestamp, length long, content binary"  # the binaryFile schema
    reader = spark.readStream.format("binaryFile").schema(schema).options(**landing.LIST_OPTIONS)
    found = reader.option("maxFilesPerTrigger", str(max_files)).load(directory)
    return found.select(F.col("_metadata.file_path").alias("fkey"), "path", "length", F.col("modificationTime").alias("landed_at"))


def stream_insert_only(spark: SparkSession, directory: str, table: str, checkpoint: str, max_files: int = MAX_FILES_PER_BATCH):
    """Start an ``availableNow`` stream that loads new landing files into ``table``.

    The stream tracks *files* (its checkpoint records which were taken); each
    micro-batch runs the batch reader and load on exactly its files, so header
    binding, quarantine and summaries are the batch semantics for any header layout.
    Returns the started ``StreamingQuery``; call ``awaitTermination()``.
    """

    def load_batch(files: DataFrame, epoch: int) -> None:
        listing = landing.named(files.where(F.col("length") > 0)).checkpoint(eager=True)  # one row per new file
        n_files = listing.count()
        if n_files:
            R.run_load(spark, landing.read_files(spark, listing), table, run_id=f"e{epoch:06d}-{uuid.uuid4().hex[:6]}",
                       listed_files=listing, max_files=n_files)

    return (
        _file_stream(spark, directory, max_files).writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


REFUSED_DIR = "_refused"


def stream_first_seen(spark: SparkSession, directory: str, sink: str, checkpoint: str, max_files: int = MAX_FILES_PER_BATCH):
    """Append each code's first row to the table ``sink``, whatever the table's other constraints say of the row.

    A micro-batch keeps the first row of each of its codes (by file and place) and appends those that no earlier one
    brought; rows without a code are left out. Files that cannot be read, or whose header the table would refuse, are
    listed with the reason under ``<sink>/_refused``. A replayed batch appends nothing. Started, ``availableNow``."""

    def take(files: DataFrame, epoch: int) -> None:
        listing = landing.named(files.where(F.col("length") > 0)).checkpoint(eager=True)  # one row per new file
        n_files = listing.count()
        if not n_files:
            return
        rows = staged(landing.read_files(spark, listing), "stream-rows")
        refused = rows.where(F.col("file_reason").isNotNull()).select("file", "file_reason").distinct()
        refused.write.mode("append").parquet(f"{sink}/{REFUSED_DIR}")
        good = L.drop_rejected(rows, refused, n_files).where(F.col(C.KEY).isNotNull())
        firsts = staged(L.first_per_key(L.typed(good).drop("reason")), "stream-firsts")
        seen = commits.current(spark, sink)
        new = staged(R.rows_not_in(spark, sink, seen.parts, firsts), "stream-new")
        R.publish(spark, sink, f"s{epoch:06d}-{uuid.uuid4().hex[:6]}", new, seen)

    return (
        _file_stream(spark, directory, max_files).writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_dedupe(
    spark: SparkSession, directory: str, sink: str, checkpoint: str, max_files: int = MAX_FILES_PER_BATCH, within: str | None = None,
):
    """Append each code the first time the stream sees it (state-only dedupe).

    Every new file is bound by its own header (any column order, missing columns NULL); a file that cannot be
    read, or whose header the table would refuse, gives one row with no code and its name and reason in
    ``refused_file`` and ``file_reason``. A file is read by one task.

    Without ``within`` the state keeps every code ever seen (exact, unbounded). With
    ``within`` (e.g. ``"2 hours"``) the file's modification time is the event time and
    ``dropDuplicatesWithinWatermark`` forgets a code once the watermark passes it, so
    state stays bounded; repeats further apart than ``within`` are emitted again.
    """
    files = _file_stream(spark, directory, max_files).where(F.col("length") > 0).select("fkey", "landed_at")
    columns = ", ".join(f"{c} string" for c in C.DATA_COLUMNS)
    rows = files.mapInPandas(landing.bound_rows, f"{columns}, landed_at timestamp, refused_file string, file_reason string")
    seen = [C.KEY, "refused_file"]
    deduped = rows.withWatermark("landed_at", within).dropDuplicatesWithinWatermark(seen) if within else rows.dropDuplicates(seen)
    return (
        deduped
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
