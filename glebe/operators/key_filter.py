"""Key filters: bitmaps that say which codes a part of the table certainly does not hold.

A filter is a table of blocks. A code's hash gives its block and a cell in each of the block's two bitmaps
(32,768 cells, 4 KB); a code is possibly there if both cells are set. With :data:`CELLS_PER_KEY` cells for each code,
about one absent code in 250 looks possible. Filters are written with their part and never changed; after a
selective delete they still name the deleted codes, which only costs a look at the part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glebe.functions import constants as C

KEYS_DIR = "_keys"
BLOCK_CELLS = 32_768  # cells of a bitmap of bitmap_construct_agg
CELLS_PER_KEY = 16
# Parts that one expression compares a code with; more parts are taken in turns.
PARTS_AT_ONCE = 500


def blocks_for(rows: int) -> int:
    return max(1, -(-rows * CELLS_PER_KEY // BLOCK_CELLS))


def _places(code: Column, blocks: Column | int) -> list[Column]:
    h = F.xxhash64(code)
    blocks = F.lit(blocks) if isinstance(blocks, int) else blocks
    return [
        F.pmod(F.shiftright(h, 30), blocks).alias("block"),
        h.bitwiseAND(F.lit(BLOCK_CELLS - 1)).alias("cell1"),
        F.shiftright(h, 15).bitwiseAND(F.lit(BLOCK_CELLS - 1)).alias("cell2"),
    ]


def write_filter(codes: DataFrame, path: str, folder: str, blocks: int) -> None:
    """Write the filter of ``codes`` (column codigo_incra). One narrow row per code is shuffled, by block, so that a
    block's bitmaps are built in one task and partial bitmaps never travel."""
    placed = codes.select(*_places(F.col(C.KEY), blocks)).repartition("block")
    built = placed.groupBy("block").agg(F.bitmap_construct_agg(F.col("cell1")).alias("bits1"), F.bitmap_construct_agg(F.col("cell2")).alias("bits2"))
    built.select(F.lit(folder).alias("folder"), "block", "bits1", "bits2").write.option("compression", "zstd").parquet(path)


def _is_set(bits: Column, cell: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(cell, 3) + 1).cast("int"), 1)), 16, 10).cast("int")
    return F.getbit(byte, cell.bitwiseAND(F.lit(7)).cast("int")) == 1


def possible(codes: DataFrame, table: str, parts: list) -> DataFrame:
    """(codigo_incra, folder): the parts that may hold a code, by their range of codes and their filter.

    ``codes`` is staged and has each code once; every part has a filter."""
    out = None
    for at in range(0, len(parts), PARTS_AT_ONCE):
        some = parts[at:at + PARTS_AT_ONCE]
        ranges = F.array(*[
            F.struct(F.lit(p.folder).alias("folder"), F.lit(p.low).alias("low"), F.lit(p.high).alias("high"), F.lit(p.blocks).cast("long").alias("blocks")) for p in some
        ])
        inside = F.filter(ranges, lambda p: F.col(C.KEY).between(p["low"], p["high"]))
        asked = codes.select(C.KEY, F.explode_outer(inside).alias("p")).where(F.col("p").isNotNull())
        asked = asked.select(C.KEY, "p.folder", *_places(F.col(C.KEY), F.col("p.blocks")))
        filters = codes.sparkSession.read.parquet(*[f"{table}/{KEYS_DIR}/{p.folder}" for p in some])
        found = asked.join(filters, ["folder", "block"]).where(_is_set(F.col("bits1"), F.col("cell1")) & _is_set(F.col("bits2"), F.col("cell2")))
        found = found.select(C.KEY, "folder")
        out = found if out is None else out.unionByName(found)
    return out
