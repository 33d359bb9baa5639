"""Mixing sources to target weights as a time-varying curriculum.

Each source has a target (words the mix takes from it) and a schedule: a
piecewise-linear weight over training time 0..1. Its cumulative demand at time
``t`` is ``target * integral(schedule, 0..t) / integral(schedule, 0..1)``. The
source's documents, laid one after another, are a supply of words; a document
that starts at word ``a`` of that supply is due at the time when the cumulative
demand reaches ``a``, so its training position is the inverse of the demand.
Sorting all documents by position (a range sort) gives the training order.

Targets: the sources, ordered by code point with null last, get the base
weights in turn and share ``share`` times all words; no target exceeds
``max_epochs`` times its source, and what a cap leaves over is shared again by
weight until no target is above its cap.

Whole documents are taken. Every complete pass over a source takes each of its
documents once. The rest of the target, ``R`` words, is filled in three steps,
each a fixed number of jobs: a prefix sum over the documents in the order of a
hash takes them up to the first that does not fit; a second one does the same
with the remaining documents that are no larger than the words still wanted; and
of the last documents taken and the documents nearest in size to what is still
wanted, :data:`POOL` together, the subset stays that comes nearest to the target
(all subsets are tried; in a source of no more documents it is the best there is).

Defined results:
  null or empty text   size 0, taken 0, no copy and no position
  null source          a source of its own, last in the order
  repeated rows        separate supply of the same size; ties are interchangeable
  repeated/null ids    spread by source and size; same rule
  empty table          empty result
  source without words target 0
  extra columns        kept by :func:`curriculum` whatever their names (they travel in one struct)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glebe.operators.broadcast import bounded_broadcast
from glebe.llm.offsets import bucket_count, with_running_total
from glebe.llm.staging import HASH52_SPAN, hash52, packed, staged, unpacked, word_count

BASE_WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_EPOCHS = 2
# Documents among which the last pass chooses its end: 2 ** POOL subsets of a source.
POOL = 12
# Knots (time, weight) of the schedules, given to the sources in turn like the base weights: the
# heavy sources fade out, the middle ones stay, the light ones come late.
SCHEDULES: tuple[tuple[tuple[float, float], ...], ...] = (
    ((0.0, 1.5), (0.6, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.4, 1.0), (1.0, 1.5)),
)


def _invert(fraction: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Time at which the integral of the schedule reaches ``fraction`` of its whole."""
    if knots[0][0] != 0.0 or knots[-1][0] != 1.0 or any(w < 0 for _, w in knots):
        raise ValueError("a schedule runs from time 0 to time 1 with weights of 0 or more")
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    whole = sum(areas)
    if whole <= 0:
        raise ValueError("a schedule needs weight somewhere")
    out, done = None, 0.0
    for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:]), areas):
        need = fraction * F.lit(whole) - F.lit(done)  # area wanted inside this segment
        slope = (w1 - w0) / (t1 - t0)
        if abs(slope) < 1e-12:
            time = F.lit(t0) + need / F.lit(w0) if w0 > 0 else F.lit(t1)
        else:  # w0 x + slope x^2 / 2 = need
            time = F.lit(t0) + (F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * need, F.lit(0.0))) - w0) / slope
        done += area
        time = F.least(F.greatest(time, F.lit(t0)), F.lit(t1))
        out = F.when(fraction * whole <= done, time) if out is None else out.when(fraction * whole <= done, time)
    return out.otherwise(F.lit(1.0))


def _numbered(rows: DataFrame, order: Column) -> DataFrame:
    """``rows`` with ``_rank`` 0.. along ``order``: a range sort, then the rows of each sorted partition counted on from those before it."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(partitions, order).sortWithinPartitions(order).withColumn("_id", F.monotonically_increasing_id())
    placed = staged(placed, "mix-order")  # an id is the partition's number times 2^33, and the row's place in it
    part = F.shiftright("_id", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn("_rank", F.col("_before") + inside).drop("_id", "_part", "_before")


def source_targets(rows: DataFrame, weights: Sequence[float] = BASE_WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, _docs, source_size, _turn (0..len(weights)-1), target.

    ``rows`` has source and size. Sources are numbered by a distributed sort. The water filling is a
    few rounds of one aggregate over the source table: sources whose share reaches their cap stay at
    it, and the words left over go to the others by weight.
    """
    totals = staged(rows.groupBy("source").agg(F.count(F.lit(1)).alias("_docs"), F.sum("size").cast("long").alias("source_size")), "mix-sources")
    numbered = _numbered(totals, F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_turn") + 1).cast("int"))
    ranked = staged(numbered.withColumn("_turn", (F.col("_rank") % len(weights)).cast("int")).withColumn("_w", weight), "mix-ranked")
    cap = F.col("source_size") * F.lit(float(max_epochs))
    words = ranked.agg(F.sum("source_size")).first()[0] or 0
    wanted = float(words) * share
    level = 0.0  # target = least(cap, weight * level)
    capped_before = -1
    while True:
        full = cap <= F.col("_w") * F.lit(level)
        n, at_cap, open_weight = ranked.agg(
            F.coalesce(F.sum(full.cast("long")), F.lit(0)),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("_w"))), F.lit(0.0)),
        ).first()
        if n == capped_before or open_weight == 0:
            break
        capped_before, level = n, max(level, (wanted - at_cap) / open_weight)
    return ranked.withColumn("target", F.least(cap, F.col("_w") * F.lit(level))).drop("_w", "_rank")


def _placed(rows: DataFrame, targets: DataFrame, sums_of: DataFrame | None = None) -> DataFrame:
    """``rows`` with their source's target and the word ``_start`` at which they begin in its supply."""

    def bucketed(df: DataFrame) -> DataFrame:
        # Rows without words move nothing and take no part, so any bucket is right for them: they are dealt out evenly.
        place = F.when(F.col("size") > 0, hash52(F.col("doc_id"), F.col("size"))).otherwise(F.floor(F.rand() * F.lit(HASH52_SPAN)).cast("long"))
        df = df.join(targets, F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumn("_h", place)
        bucket = F.floor(F.col("_h") / F.lit(HASH52_SPAN) * bucket_count(F.col("_docs"))).cast("long")
        return df.withColumn("_g", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).withColumn("_b", bucket)

    sums = None if sums_of is None else bucketed(sums_of)
    return with_running_total(bucketed(rows), ["_g"], "_b", [F.col("_h"), F.col("doc_id")], "size", "_start", sums_of=sums)


def _last_pass(placed: DataFrame) -> DataFrame:
    """(_t, _at, _words, _in, _begin): the documents (group, start and size) of which the last pass does not simply take the prefix,
    whether it takes them, and the word of the pass at which they begin."""
    places = staged(placed.where("size > 0").select("_g", "_b", "_start", "size", "_rest"), "mix-places")
    prefix = F.col("_start") + F.col("size") <= F.col("_rest")
    # The sources once more, with the words that the prefix takes.
    firsts = places.groupBy("_g").agg(F.first("_rest").alias("_all"), F.coalesce(F.max(F.when(prefix, F.col("_start") + F.col("size"))), F.lit(0)).alias("_took1"))
    firsts = staged(firsts, "mix-prefixes")
    fitting = places.where(~prefix).join(bounded_broadcast(firsts), "_g").where(F.col("size") <= F.col("_all") - F.col("_took1"))
    fitting = with_running_total(fitting, ["_g"], "_b", [F.col("_start")], "size", "_run")
    seconds = fitting.where(F.col("_run") + F.col("size") <= F.col("_all") - F.col("_took1"))
    seconds = staged(seconds.select(F.col("_g").alias("_g2"), F.col("_start").alias("_start2"), (F.col("_took1") + F.col("_run")).alias("_begin"), F.col("size").alias("_size2")), "mix-seconds")
    took2 = seconds.groupBy(F.col("_g2").alias("_g")).agg(F.sum("_size2").alias("_took2"))
    taken = F.col("_took1") + F.coalesce("_took2", F.lit(0))
    ends = staged(firsts.join(took2, "_g", "left").select("_g", taken.alias("_took"), (F.col("_all") - taken).alias("_gap")), "mix-ends")
    marked = places.join(bounded_broadcast(seconds), (F.col("_g") == F.col("_g2")) & (F.col("_start") == F.col("_start2")), "left")
    marked = staged(marked.select("_g", "_start", "size", "_begin", (prefix | F.col("_begin").isNotNull()).alias("_taken")), "mix-marked")

    def first_of(rows: DataFrame, *order: Column) -> DataFrame:
        ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_g").orderBy(*order)))
        return ranked.where(F.col("_n") <= POOL).select("_g", "_taken", "_n", "_start", "size", "_begin")

    latest = first_of(marked.where("_taken"), F.col("_start").desc())
    nearest = first_of(marked.where("not _taken").join(bounded_broadcast(ends), "_g"), F.abs(F.col("size") - F.col("_gap")), F.col("_start"))
    ranked = latest.unionByName(nearest).withColumn("_turn", F.row_number().over(Window.partitionBy("_g").orderBy("_n", F.col("_taken").desc())))
    pool = staged(ranked.where(F.col("_turn") <= POOL).drop("_turn"), "mix-pool")
    # The documents taken come first; bit i of a subset's number stands for document i.
    lists = pool.groupBy("_g").agg(F.sort_array(F.collect_list(F.struct((~F.col("_taken")).alias("out"), "_n", "_start", "size", "_begin"))).alias("_pool"))
    lists = lists.join(ends, "_g")
    sums = F.aggregate("_pool", F.array(F.lit(0).cast("long")), lambda done, d: F.concat(done, F.transform(done, lambda x: x + d["size"])))
    held = F.aggregate("_pool", F.lit(0).cast("long"), lambda x, d: x + F.when(d["out"], F.lit(0)).otherwise(d["size"]))
    lists = lists.withColumn("_sums", sums).withColumn("_held", held)
    lists = lists.withColumn("_best", F.array_min(F.transform("_sums", lambda x, m: F.struct(F.abs(x - (F.col("_gap") + F.col("_held"))), m.alias("mask"))))["mask"])
    chosen = lists.select("_g", "_took", "_held", "_best", F.posexplode("_pool").alias("_i", "_d"))
    chosen = chosen.withColumn("_in", F.call_function("shiftright", F.col("_best"), F.col("_i")).bitwiseAND(F.lit(1)) == 1)
    kept = F.sum(F.when(F.col("_in") & ~F.col("_d.out"), F.col("_d.size")).otherwise(0)).over(Window.partitionBy("_g"))  # POOL rows at most
    begins = F.when(F.col("_d.out"), F.col("_took") - F.col("_held") + kept).otherwise(F.col("_d._begin"))
    chosen = staged(chosen.select(F.col("_g").alias("_t"), F.col("_d._start").alias("_at"), F.col("_d.size").alias("_words"), "_in", begins.alias("_begin")), "mix-chosen")
    others = seconds.select(F.col("_g2").alias("_t"), F.col("_start2").alias("_at"), F.col("_size2").alias("_words"), F.lit(True).alias("_in"), "_begin")
    others = others.join(bounded_broadcast(chosen.select("_t", "_at")), ["_t", "_at"], "left_anti")
    return staged(chosen.unionByName(others), "mix-last-pass")


def mixed(rows: DataFrame, sizes: DataFrame, weights: Sequence[float] = BASE_WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
          schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES) -> DataFrame:
    """``rows`` with source_size, target, copies, taken and positions (one training position in 0..1 for each copy taken).

    ``rows`` has doc_id, source, size and maybe a struct ``_row``; ``sizes`` is a staged table of the same
    rows' doc_id, source and size, for the totals. ``rows`` is read once and shuffles once, by (source, bucket).
    """
    if len(schedules) != len(weights):
        raise ValueError("one schedule for each base weight")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = source_targets(sizes, weights, share, max_epochs).withColumnRenamed("source", "_s").withColumn("_passes", passes)
    targets = staged(targets.withColumn("_rest", F.col("target") - F.col("_passes") * F.col("source_size")), "mix-targets")
    last = _last_pass(_placed(sizes, bounded_broadcast(targets)))
    out = _placed(rows, bounded_broadcast(targets), sums_of=sizes)
    decided = (F.col("_g") == F.col("_t")) & (F.col("_start") == F.col("_at")) & (F.col("size") == F.col("_words"))
    out = out.join(bounded_broadcast(last), decided, "left")
    once_more = F.coalesce(F.col("_in"), F.col("_start") + F.col("size") <= F.col("_rest"))
    out = out.withColumn("copies", F.when(F.col("size") > 0, F.col("_passes") + once_more.cast("long")).otherwise(F.lit(0)).cast("int"))

    def position(copy: int) -> Column:
        begins = F.when(F.col("_passes") == copy, F.coalesce("_begin", "_start")).otherwise(F.col("_start"))
        reached = F.least((copy * F.col("source_size") + begins) / F.col("target"), F.lit(1.0))
        return F.when(F.col("copies") > copy, _by_turn([_invert(reached, s) for s in schedules]))

    positions = F.filter(F.array(*[position(c) for c in range(max_epochs)]), lambda p: p.isNotNull())
    return (
        out.withColumn("positions", positions)
        .withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
        .drop("_g", "_b", "_h", "_start", "_passes", "_rest", "_docs", "_turn", "_t", "_at", "_words", "_in", "_begin")
    )


def _by_turn(columns: list[Column]) -> Column:
    out = F.when(F.col("_turn") == 0, columns[0])
    for turn, column in enumerate(columns[1:], 1):
        out = out.when(F.col("_turn") == turn, column)
    return out


def in_training_order(rows: DataFrame, position: str) -> DataFrame:
    """Range sort by position: many sorted partitions, no single task. Rows of one position (those without any, above
    all) are spread by a hash of their doc_id and size."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.withColumn("_tie", hash52(F.col("doc_id"), F.col("size")))
    return placed.repartitionByRange(partitions, position, "_tie").sortWithinPartitions(position, "_tie").drop("_tie")


def mix_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, position (of the first copy), in training order."""
    sizes = staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix")
    first = F.round(F.try_element_at("positions", F.lit(1)), 6)
    out = mixed(sizes, sizes).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", "copies", first.alias("position")
    )
    return in_training_order(out, "position")


def curriculum(docs: DataFrame) -> DataFrame:
    """The mix itself: a row of ``docs`` for every copy taken, its columns unchanged, in training order."""
    rows = packed(docs, doc_id=F.col("doc_id"), source=F.col("source"), size=word_count(F.col("text")))
    sizes = staged(rows.drop("_row"), "mix")
    out = mixed(rows, sizes).select("_row", "doc_id", "size", F.explode("positions").alias("position"))
    return unpacked(in_training_order(out, "position"))
