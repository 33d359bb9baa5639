"""SimHash near-duplicates through deletion-variant signatures.

A 64-bit fingerprint is the bitwise majority over the XXH64 of a text's word
shingles. Fingerprints link when at most :data:`MAX_BITS` = 2 bits differ. They are
cut into two halves only: of two linked fingerprints, one half differs by at
most one bit. So each half is indexed under its 32 one-wildcard variants (bit i
blanked): halves that differ by at most one bit share a variant. An equality
join on (half, i, blanked value) finds all candidates, and the number of
differing bits of the whole fingerprints is checked inside the join. Each pair
is accepted under one variant only.

Equal fingerprints are one node of the link graph, so copies never meet in
pairs. A variant shared by very many different fingerprints is subdivided by
the same method: the other half is cut into two quarters, one of which again
differs by at most one bit, and the index key is extended by its 16 variants.

Defined results:
  null/empty text   no words: fingerprint 0, linked like any other
  fewer words than a shingle   the whole sequence is the only shingle
  null doc_id       never the smallest; a component of null ids alone has component_id null
  repeated rows     the same fingerprint and component; :func:`drop_near_copies` keeps one of them
  empty table       empty result
  extra columns     kept by :func:`drop_near_copies` whatever their names
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from glebe.llm.components import components
from glebe.llm.staging import packed, staged, unpacked

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
HALF_BITS = 32
QUARTER_BITS = 16
# Different fingerprints with one half in common from which that half's variants are subdivided.
HOT_HALF = 1_000
# Shingles whose bits are counted at once.
COUNTED = 16_384


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of one text."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and white space 0x20, 0x09-0x0D.
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(s, SEED) for s in map(b" ".join, zip(*[words[i:] for i in range(shingle_words)]))]
    bits = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(bits), COUNTED):
        set_bits += np.unpackbits(bits[at:at + COUNTED], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * set_bits > len(bits)).astype(np.uint8), bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    @pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle_words) for t in texts], dtype="int64")

    return of(text)


def _half(fp: Column, half: int) -> Column:
    return F.shiftright(fp, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))


def _variants(value: Column, bits: int, tag: int) -> Column:
    """Array of keys: the value with bit i blanked, with i and ``tag`` in the bits above it."""
    return F.array(*[
        value.bitwiseAND(F.lit(((1 << bits) - 1) & ~(1 << i))).bitwiseOR(F.lit(((tag << 6) | i) << bits)) for i in range(bits)
    ])


def _wild(key: Column, bits: int) -> Column:
    return F.shiftright(key, bits).bitwiseAND(F.lit(63))


def _tag(key: Column, bits: int) -> Column:
    return F.shiftright(key, bits + 6)


def _indexed(fps: DataFrame, half: int) -> DataFrame:
    return fps.select(F.explode(_variants(_half(F.col("fp"), half), HALF_BITS, half)).alias("key"), "fp")


def _once(diff: Column, wild: Column) -> Column:
    """Accept equal values under variant 0 only; values that differ by one bit share one variant."""
    return (diff != 0) | (wild == 0)


def _accepted(diff: Column) -> Column:
    """A pair whose lower halves differ by one bit at most is accepted there; else in the upper half."""
    in_low = _tag(F.col("key"), HALF_BITS) == 0
    own = F.when(in_low, _half(diff, 0)).otherwise(_half(diff, 1))
    return _once(own, _wild(F.col("key"), HALF_BITS)) & (in_low | (F.bit_count(_half(diff, 0)) > 1))


def _accepted_in_quarter(diff: Column) -> Column:
    other = F.when(_tag(F.col("key"), HALF_BITS) == 0, _half(diff, 1)).otherwise(_half(diff, 0))
    low, high = other.bitwiseAND(F.lit(0xFFFF)), F.shiftright(other, QUARTER_BITS)
    in_low = _tag(F.col("key2"), QUARTER_BITS) == 0
    own = F.when(in_low, low).otherwise(high)
    return _accepted(diff) & _once(own, _wild(F.col("key2"), QUARTER_BITS)) & (in_low | (F.bit_count(low) > 1))


def _linked(index: DataFrame, accepted) -> DataFrame:
    keys = [c for c in index.columns if c != "fp"]
    a = index.withColumnRenamed("fp", "a")
    b = index.select(*[F.col(k).alias("_" + k) for k in keys], F.col("fp").alias("b"))
    diff = F.col("a").bitwiseXOR(F.col("b"))
    on = (F.col("a") < F.col("b")) & (F.bit_count(diff) <= MAX_BITS) & accepted(diff)
    for k in keys:
        on = on & (F.col(k) == F.col("_" + k))
    return a.join(b, on).select("a", "b")


def links(fps: DataFrame) -> DataFrame:
    """All pairs (a, b) of different fingerprints with at most two differing bits. ``fps`` is staged: distinct ``fp``."""
    index = _indexed(fps, 0).unionByName(_indexed(fps, 1))
    hot = _hot_keys(fps)
    if hot is None:
        return _linked(index, _accepted)
    many = staged(index.join(hot, "key", "left_semi"), "simhash-hot")
    out = _linked(index.join(hot, "key", "left_anti"), _accepted)
    other = F.when(_tag(F.col("key"), HALF_BITS) == 0, _half(F.col("fp"), 1)).otherwise(_half(F.col("fp"), 0))

    def quarters(quarter: int) -> DataFrame:
        value = F.shiftright(other, QUARTER_BITS * quarter).bitwiseAND(F.lit(0xFFFF))
        return many.select("key", F.explode(_variants(value, QUARTER_BITS, quarter)).alias("key2"), "fp")

    return out.unionByName(_linked(quarters(0).unionByName(quarters(1)), _accepted_in_quarter))


def _hot_keys(fps: DataFrame) -> DataFrame | None:
    """Variants of the halves that more than HOT_HALF fingerprints share; None if there is none."""
    halves = fps.select(F.explode(F.array(*[F.struct(F.lit(h).alias("half"), _half(F.col("fp"), h).alias("value")) for h in (0, 1)])).alias("h"))
    hot = halves.groupBy("h.half", "h.value").count().where(F.col("count") > HOT_HALF)
    keys = F.when(F.col("half") == 0, _variants(F.col("value"), HALF_BITS, 0)).otherwise(_variants(F.col("value"), HALF_BITS, 1))
    hot = staged(hot.select(F.explode(keys).alias("key")).distinct(), "simhash-hot-keys")
    return None if hot.isEmpty() else hot


def _components(rows: DataFrame) -> DataFrame:
    """(fp, component_id, keep_uid) for the staged rows (doc_id, fp, uid)."""
    last = (1 << 63) - 1
    fps = staged(
        rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.min_by("uid", F.coalesce("doc_id", F.lit(last))).alias("uid")), "simhash-fps"
    )
    roots = components(links(fps))
    rooted = fps.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp")).drop("node")
    rooted = staged(rooted, "simhash-roots")
    groups = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.min_by("uid", F.coalesce("first", F.lit(last))).alias("keep_uid"))
    return staged(rooted.select("fp", "root").join(groups, "root").drop("root"), "simhash-components")


def near_copy_components(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    rows = docs.select("doc_id", fingerprint_column(F.col("text"), shingle_words).alias("fp"))
    rows = staged(rows.withColumn("uid", F.monotonically_increasing_id()), "simhash")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(_components(rows), "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id. All columns unchanged."""
    rows = packed(docs, doc_id=F.col("doc_id"), fp=fingerprint_column(F.col("text"), shingle_words))
    rows = staged(rows.withColumn("uid", F.monotonically_increasing_id()), "simhash-rows")
    kept = _components(rows.drop("_row")).select(F.col("keep_uid").alias("uid")).distinct()
    return unpacked(rows.join(kept, "uid", "left_semi"))
