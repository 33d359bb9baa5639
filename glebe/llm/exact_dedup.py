"""Exact deduplication with two passes over a Bloom filter.

Pass 1 sets, for the hash of every text, two cells of a blocked Bloom filter and
keeps the cells that were set at least twice. Pass 2 looks the hash of every row
up in these cells: a row with a cell that was set once only cannot have an equal,
and passes straight through; only the rest (copies and a few false positives)
shuffle, by the full SHA-256, and are grouped exactly. All of it is DataFrame
operations.

The filter is a table of blocks of 32,768 cells (a 4 KB bitmap each), about
:data:`CELLS_PER_ROW` cells for each row; a row's cells lie in one block, so a
lookup is one equality join on the block's number. That join broadcasts the
filter while it is below :data:`BROADCAST_BLOCKS` blocks (checked by its count);
beyond, it is a sort-merge join of narrow rows (id and hashes, no text).

Defined results:
  null text      equal to the empty text
  null doc_id    smaller than every id; a group of null ids alone keeps one row, keep_id null
  repeated rows  rows with the same doc_id and text are copies too; one of them is kept
  empty table    empty result
  extra columns  not read by :func:`exact_groups`; :func:`drop_copies` keeps them whatever their names
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glebe.llm.staging import ascii_lower, packed, staged, unpacked

BLOCK_CELLS = 32_768  # cells of a bitmap of bitmap_construct_agg
CELLS_PER_ROW = 16
# 16,384 blocks of 4 KB: 64 MB, for 33 million rows.
BROADCAST_BLOCKS = 16_384
LEAST_ID = -(1 << 63)


def _cells(hash64: Column, blocks: int) -> list[Column]:
    """Block number and the two cells in it, from separate bits of a 64-bit hash."""
    return [
        F.pmod(F.shiftright(hash64, 30), F.lit(blocks)).alias("_block"),
        hash64.bitwiseAND(F.lit(BLOCK_CELLS - 1)).alias("_cell1"),
        F.shiftright(hash64, 15).bitwiseAND(F.lit(BLOCK_CELLS - 1)).alias("_cell2"),
    ]


def repeated_cells(hashes: DataFrame, blocks: int) -> DataFrame:
    """Pass 1: (block, bitmap of the cells that at least two rows set), from a column ``_hash``."""
    cells = hashes.select(*_cells(F.col("_hash"), blocks))
    both = F.when(F.col("_cell1") == F.col("_cell2"), F.array("_cell1")).otherwise(F.array("_cell1", "_cell2"))
    counts = cells.select("_block", F.explode(both).alias("_cell")).groupBy("_block", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    return counts.where("_n > 1").groupBy("_block").agg(F.bitmap_construct_agg(F.col("_cell")).alias("_bits"))


def _is_set(bits: Column, cell: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(cell, 3) + 1).cast("int"), 1)), 16, 10).cast("int")
    return F.getbit(byte, cell.bitwiseAND(F.lit(7)).cast("int")) == 1


def maybe_repeated(hashes: DataFrame) -> DataFrame:
    """Pass 2: ``hashes`` (staged, with ``_hash``) plus boolean ``_maybe``: false only where the hash occurs once."""
    rows = hashes.count()
    blocks = max(1, -(-rows * CELLS_PER_ROW // BLOCK_CELLS))
    filters = staged(repeated_cells(hashes, blocks), "bloom")
    if blocks <= BROADCAST_BLOCKS:
        filters = F.broadcast(filters)
    looked_up = hashes.select("*", *_cells(F.col("_hash"), blocks)).join(filters, "_block", "left")
    maybe = F.coalesce(_is_set(F.col("_bits"), F.col("_cell1")) & _is_set(F.col("_bits"), F.col("_cell2")), F.lit(False))
    return looked_up.withColumn("_maybe", maybe).drop("_block", "_cell1", "_cell2", "_bits")


def _groups(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, _sha, _hash, a staged unique _uid) with keep_id, group_size and kept."""
    marked = staged(maybe_repeated(rows), "exact-marked")
    single = marked.where(~F.col("_maybe")).drop("_maybe")
    again = marked.where("_maybe").drop("_maybe")
    # One row per text; partial aggregation leaves one row per task of a hot text.
    groups = staged(
        again.groupBy("_sha").agg(
            F.max("doc_id").alias("keep_id"),
            F.count(F.lit(1)).alias("group_size"),
            F.max_by("_uid", F.coalesce("doc_id", F.lit(LEAST_ID))).alias("_keep_uid"),
        ),
        "exact-groups",
    )
    # Both sides are plain scans, so AQE splits the partition of a hot text.
    grouped = again.join(groups, "_sha").withColumn("kept", F.col("_uid") == F.col("_keep_uid")).drop("_keep_uid")
    passed = (
        single.withColumn("keep_id", F.col("doc_id")).withColumn("group_size", F.lit(1).cast("long")).withColumn("kept", F.lit(True))
    )
    return passed.unionByName(grouped.select(*passed.columns))


def _sha(text: Column) -> Column:
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256. The text is read once and never shuffled."""
    hashed = docs.select("doc_id", _sha(F.col("text")).alias("_sha"))
    rows = staged(hashed.select("*", F.xxhash64("_sha").alias("_hash"), F.monotonically_increasing_id().alias("_uid")), "exact")
    return _groups(rows).select("doc_id", "keep_id", "group_size", "kept", F.col("_sha").alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text an equal text with a larger doc_id repeats; all columns unchanged."""
    hashed = packed(docs, doc_id=F.col("doc_id"), _sha=_sha(F.col("text")))
    rows = staged(hashed.select("*", F.xxhash64("_sha").alias("_hash"), F.monotonically_increasing_id().alias("_uid")), "exact-rows")
    gone = _groups(rows.drop("_row")).where(~F.col("kept")).select("_uid")
    return unpacked(rows.join(gone, "_uid", "left_anti"))
