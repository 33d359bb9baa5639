"""Product codes of vectors, with memoised grid cells.

A component x becomes the integer floor(4096 x); a vector is cut into equal consecutive parts, and each part is
replaced by the index of the nearest entry of its position's codebook. The codebooks are trained by rounds of
assignment and averaging, all in whole numbers, so every run gives the same codes.

The nearest entry is found through a coarse grid. A part lies in a cell, a box of :data:`CELL` whole numbers a side.
From the box alone follow, for every entry, the least and the greatest distance that any part in it can have; an entry
whose least distance exceeds the smallest greatest distance is dominated: no part of the box is nearest to it. What is
not dominated is cached under the cell, and only these entries are evaluated exactly for the parts that fall into it.
(Entries of equal distance are never dominated, so ties still go to the lower index.)

A round is one Arrow pass over the table; each task adds up its parts by entry and sends on one row per position,
entry and component, so what is shuffled and what reaches the driver is as large as the codebooks, whatever the table.

Defined results:
  null vector, null or non-finite component   no row
  a component beyond +-2^76 (2^88 as an integer)   no row: sums of such components are out of range
  length        that of the smallest kept vec_id, which must be a multiple of the number of parts; others give no row
  null vec_id   after every id when the codebooks begin
  equal vec_ids, repeated rows   every row counts; rows of one id are ordered by their vectors
  fewer rows than entries        as many entries as rows
  empty table   empty result
  error beyond a long            the largest long
  extra columns                  not read
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glebe.llm.staging import staged
from glebe.operators.broadcast import bounded_broadcast

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
CELL = 1_024
# Cells that a task remembers of one codebook; it forgets them all when they are more.
MEMO_CELLS = 50_000
# From here on whole numbers are Python's, as squares might leave 64 bits.
WIDE = 1 << 28
LARGEST = 2.0**76
MOST_LONG = (1 << 63) - 1


def whole_numbers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE x): 64-bit, or Python's whole numbers where one of them is WIDE or more."""
    scaled = np.floor(x.astype(np.float64) * SCALE)
    if scaled.size == 0 or np.abs(scaled).max() < WIDE:
        return scaled.astype(np.int64)
    return np.frompyfunc(int, 1, 1)(scaled)


def nearest_of_all(parts: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance by comparing with every entry (any whole numbers)."""
    off = ((parts[:, None, :] - codebook[None, :, :]) ** 2).sum(2)
    best = np.array([min(range(len(row)), key=row.__getitem__) for row in off], np.int64)
    return best, off[np.arange(len(off)), best]


class PartCoder:
    """Nearest entries of one codebook, by remembered cells."""

    def __init__(self, codebook: list[list[int]], cell: int = CELL):
        self.wide = any(abs(x) >= WIDE for entry in codebook for x in entry)
        self.codebook = np.array(codebook, dtype=object if self.wide else np.int64)
        self.cell = cell
        self.memo: dict[bytes, int] = {}
        self.near = np.zeros((0, len(codebook)), bool)

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """For every cell the entries that may be nearest to some part in it."""
        low = cells[:, None, :] * self.cell
        high = low + (self.cell - 1)
        below, above = low - self.codebook, self.codebook - high
        least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(2)
        most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(2)
        return least <= most.min(1, keepdims=True)

    def _rows_of(self, cells: np.ndarray) -> np.ndarray:
        """The memo's row of every cell; cells not seen before are added."""
        keys = np.ascontiguousarray(cells).view(np.dtype((np.void, cells.shape[1] * 8))).ravel()
        different, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.memo) + len(different) > MEMO_CELLS:
            self.memo, self.near = {}, self.near[:0]
        names = [k.tobytes() for k in different]
        new = [i for i, k in enumerate(names) if k not in self.memo]
        if new:
            self.memo.update((names[i], len(self.near) + n) for n, i in enumerate(new))
            self.near = np.concatenate([self.near, self.undominated(cells[first[new]])])
        return np.array([self.memo[k] for k in names], np.int64)[inverse.ravel()]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance, for every part."""
        if len(parts) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.wide or parts.dtype == object:
            return nearest_of_all(parts.astype(object), self.codebook.astype(object))
        memo_row = self._rows_of(parts // self.cell)
        row, entry = np.nonzero(self.near[memo_row])
        off = ((parts[row] - self.codebook[entry]) ** 2).sum(1)
        starts = np.searchsorted(row, np.arange(len(parts)))
        best = np.minimum.reduceat(off, starts)
        hits = np.nonzero(off == best[row])[0]
        first = hits[np.r_[True, row[hits][1:] != row[hits][:-1]]]  # the lowest index of a tie
        return entry[first], best


def vectors_of(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and the matrix of the vectors that are kept."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten()
    if values.null_count:
        values = pc.fill_null(values, math.nan)
    values = values.to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    rows = np.nonzero(lengths == length)[0]
    matrix = values[starts[rows][:, None] + np.arange(length)]
    with np.errstate(invalid="ignore"):
        good = (np.abs(matrix) <= LARGEST).all(1)
    return rows[good], matrix[good]


def _is_kept(vector: Column) -> Column:
    return (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) <= LARGEST))  # a NaN is above every number


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> tuple[int, list[list[list[int]]]]:
    """Length of the vectors, and by part the entries that the codebooks begin with."""
    kept = vectors.where(F.coalesce(_is_kept(F.col("embedding")), F.lit(False)))
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    first = kept.orderBy(*order).limit(1).collect()
    if not first:
        return 0, []
    length = len(first[0]["embedding"])
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    rows = kept.where(F.size("embedding") == length).orderBy(*order).limit(entries).collect()
    numbers = [[math.floor(x * SCALE) for x in r["embedding"]] for r in rows]
    d = length // parts
    return length, [[v[p * d:(p + 1) * d] for v in numbers] for p in range(parts)]


def retrained(vectors: DataFrame, length: int, codebooks: list[list[list[int]]]) -> list[list[list[int]]]:
    """The codebooks after one round: entries replaced by the floored mean of their parts."""
    parts, d = len(codebooks), length // len(codebooks)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = [PartCoder(c) for c in codebooks]
        totals = np.zeros((parts, len(codebooks[0]), d), object)
        counts = np.zeros((parts, len(codebooks[0])), np.int64)
        for batch in batches:
            _, matrix = vectors_of(batch.column(0), length)
            numbers = whole_numbers(matrix)
            for p, coder in enumerate(coders):
                part = numbers[:, p * d:(p + 1) * d]
                entry, _ = coder.nearest(part)
                order = np.argsort(entry, kind="stable")
                used, starts, many = np.unique(entry[order], return_index=True, return_counts=True)
                if len(used):
                    totals[p, used] += np.add.reduceat(part[order], starts, axis=0).astype(object)
                    counts[p, used] += many
        at = [(p, e, j) for p in range(parts) for e in range(len(codebooks[0])) if counts[p, e] for j in range(d)]
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array([k[i] for k in at], pa.int32()) for i in range(3)),
                pa.array([int(totals[k]) for k in at], pa.decimal128(38, 0)), pa.array([int(counts[k[:2]]) for k in at], pa.int64()),
            ],
            ["part", "entry", "j", "total", "n"],
        )

    sums = vectors.select("embedding").mapInArrow(add_up, "part int, entry int, j int, total decimal(38,0), n long")
    grouped = sums.groupBy("part", "entry", "j").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    out = [[list(entry) for entry in c] for c in codebooks]
    for r in grouped.collect():  # a row for each number in the codebooks at most
        out[r["part"]][r["entry"]][r["j"]] = int(r["total"]) // r["n"]
    return out


def coded(vectors: DataFrame, length: int, codebooks: list[list[list[int]]]) -> DataFrame:
    """vec_id, label, code and error of every kept vector."""
    d = length // len(codebooks)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = [PartCoder(c) for c in codebooks]
        for batch in batches:
            rows, matrix = vectors_of(batch.column(2), length)
            numbers = whole_numbers(matrix)
            codes, error = np.zeros((len(rows), len(coders)), np.uint8), np.zeros(len(rows), object)
            for p, coder in enumerate(coders):
                codes[:, p], off = coder.nearest(numbers[:, p * d:(p + 1) * d])
                error += off.astype(object)
            taken = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(taken), batch.column(1).take(taken), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                    pa.array([min(int(x), MOST_LONG) for x in error], pa.int64()),
                ],
                ["vec_id", "label", "code", "error"],
            )

    kind = vectors.schema
    schema = T.StructType([kind["vec_id"], kind["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return vectors.select("vec_id", "label", "embedding").mapInArrow(code, schema)


def codebooks_text(codebooks: list[list[list[int]]]) -> str:
    return ",".join(str(x) for c in codebooks for entry in c for x in entry)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[int, list[list[list[int]]]]:
    """Length of the vectors and the codebooks, by part and entry."""
    length, codebooks = first_codebooks(vectors, parts, entries)
    for _ in range(rounds if codebooks else 0):
        codebooks = retrained(vectors, length, codebooks)
    return length, codebooks


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256. ``vectors`` has vec_id, embedding, label."""
    vectors = vectors.select("vec_id", "embedding", "label")
    length, codebooks = train(vectors, parts, entries, rounds)
    rows = coded(vectors, length, codebooks) if codebooks else vectors.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).where(F.lit(False))
    rows = staged(rows, "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST_LONG).cast("decimal(38,0)")).cast("long")
    labels = staged(rows.groupBy(F.col("label").alias("_l")).agg(total.alias("label_error")), "vector-labels")
    joined = rows.join(bounded_broadcast(labels), F.col("label").eqNullSafe(F.col("_l")))
    digest = hashlib.sha256(codebooks_text(codebooks).encode()).hexdigest()
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
