"""Line deduplication with a suffix array over line ids.

Every non-blank line (white space around it cut off) gets an id; documents are sequences of ids, ordered by
doc_id. Suffixes are sorted by distributed prefix doubling: rank 0 of a position is the order of its line,
and the rank of the first 2^(k+1) lines is the order of the pair (rank k here, rank k 2^k lines on), found by
a range sort of the different pairs. A suffix whose first 2^k lines occur once needs no further sorting and
leaves; so the array holds repeated suffixes only and shrinks from round to round.

Suffixes that share their first l lines stand side by side: an interval of the array with a longest common
prefix of at least l, named by the pair (rank k here, rank k at l - 2^k), 2^k <= l < 2^(k+1). A repeated run
counts from ``min_words`` words on (:data:`MIN_WORDS` unless given), so the shortest windows of lines with so many words are looked at: the
one that begins at each line and the one that ends at each line. In every interval of such windows the earliest
in document order stays and the lines of the others are deleted. A line of a run lies in the window that begins
at it, or, if fewer words are left of the run, in the window that ends the run; so the union of the windows is
the maximal run. All of it is DataFrame operations; the array is sorted as deep as the longest of these windows,
log2(min_words) rounds at most, as a line holds a word at least.

Defined results:
  null text       no line; the text stays null
  empty text      no line; stays as it is
  blank lines     never compared, never deleted; runs reach across them
  null doc_id     before every id
  equal doc_ids   in the order of the table
  repeated rows   the second copy is a later copy
  overlaps        a run that repeats itself keeps its first period (every later window is a copy of an earlier one)
  empty table     empty result
  extra columns   kept by :func:`drop_repeated_lines` whatever their names
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glebe.llm.staging import WORD_PATTERN, packed, staged, unpacked

MIN_WORDS = 50


def _lines(text: Column) -> Column:
    """Array of (line number, trimmed line) of the non-blank lines."""
    numbered = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("line"), F.btrim(x, F.lit(" \t\r\x0b\x0c")).alias("words")))
    return F.filter(numbered, lambda s: s["words"] != "")


def _ranked(keys: DataFrame, by: list[str], purpose: str) -> DataFrame:
    """``keys`` with ``rank``: unique and rising along ``by``, from a range sort (no task sees all keys)."""
    partitions = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = keys.repartitionByRange(partitions, *by).sortWithinPartitions(*by)
    return staged(placed.withColumn("rank", F.monotonically_increasing_id()), purpose)


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """_uid, seq (number among the document's non-blank lines), rank (of the line), place (order of all lines), len, tail, tail_place.

    Only lines that occur more than once. ``len``: lines of the shortest window from here with ``min_words`` words
    whose lines all occur more than once, else null. ``tail``: lines of the shortest such window that ends here,
    and ``tail_place`` the place of its first line; null if that line's ``len`` is the same window. ``docs`` is
    staged: _uid, doc_id, text.
    """
    exploded = docs.select("_uid", "doc_id", F.posexplode(_lines(F.col("text"))).alias("seq", "l"))
    text = F.col("l.words")
    # 128 bits name a line.
    lines = exploded.select("_uid", "doc_id", "seq", F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"),
                            F.regexp_count(text, F.lit(WORD_PATTERN)).alias("words"))
    lines = staged(lines, "lines")
    again = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = _ranked(again, ["h1", "h2"], "line-ranks")
    kept = lines.join(again, ["h1", "h2"]).select("_uid", "doc_id", "seq", "words", "rank")
    # Order of the lines of all documents; the ids freeze when the table is written.
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = kept.repartitionByRange(partitions, F.col("doc_id").asc_nulls_first(), "_uid", "seq").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_uid", "seq")
    kept = staged(kept.withColumn("place", F.monotonically_increasing_id()).drop("doc_id"), "line-places")
    # Islands of consecutive repeated lines of a document, and the words before each line of its island.
    document = Window.partitionBy("_uid").orderBy("seq")
    kept = kept.repartition("_uid").withColumn("island", F.col("seq") - F.row_number().over(document))
    island = Window.partitionBy("_uid", "island")
    before = F.sum("words").over(island.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words")
    kept = kept.withColumn("before", before.cast("long")).withColumn("whole", F.sum("words").over(island))
    reach = F.count(F.lit(1)).over(island.orderBy("before").rangeBetween(0, min_words - 1))
    length = F.when(F.col("whole") - F.col("before") >= min_words, reach)
    kept = kept.withColumn("len", length.cast("int")).withColumn("upto", F.col("before") + F.col("words"))
    ending = island.orderBy("upto").rangeBetween(1 - min_words, 0)
    kept = kept.withColumn("back", F.count(F.lit(1)).over(ending).cast("int"))
    kept = kept.withColumn("back_len", F.first("len").over(ending)).withColumn("back_place", F.first("place").over(ending))
    apart = (F.col("upto") >= min_words) & (F.col("back") != F.col("back_len"))
    kept = kept.withColumn("tail", F.when(apart, F.col("back"))).withColumn("tail_place", F.when(apart, F.col("back_place")))
    return staged(kept.select("_uid", "seq", "rank", "place", "len", "tail", "tail_place"), "line-sequence")


def _ahead(left: DataFrame, right: DataFrame, by: Column) -> DataFrame:
    """``left`` with ``next``: the rank in ``right`` that stands ``by`` lines further on in the same document."""
    shifted = right.select(F.col("_uid").alias("_u"), F.col("seq").alias("_s"), F.col("rank").alias("next"))
    return left.join(shifted, (F.col("_uid") == F.col("_u")) & (F.col("seq") + by == F.col("_s"))).drop("_u", "_s")


def _doubled(level: DataFrame, width: int) -> DataFrame:
    """The next level of the suffix array: positions whose first ``2 * width`` lines occur more than once, with their rank."""
    pairs = staged(_ahead(level, level, F.lit(width)), "suffix-pairs")
    again = pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("rank").alias("a"), F.col("next").alias("b"))
    ranks = _ranked(again, ["a", "b"], "suffix-ranks")
    joined = pairs.join(ranks.withColumnRenamed("rank", "r"), (F.col("rank") == F.col("a")) & (F.col("next") == F.col("b")))
    return staged(joined.select("_uid", "seq", F.col("r").alias("rank")), "suffix-level")


def later_copies(sequence: DataFrame) -> DataFrame:
    """(_uid, seq, len): windows of lines that occur earlier."""
    longest = sequence.agg(F.max(F.greatest("len", "tail"))).first()[0]
    tails = sequence.where("tail is not null").select("_uid", (F.col("seq") - F.col("tail") + 1).alias("seq"), F.col("tail_place").alias("place"), F.col("tail").alias("len"))
    starts = sequence.where("len is not null").select("_uid", "seq", "place", "len").unionByName(tails)
    level, width, found = sequence.select("_uid", "seq", "rank"), 1, None
    while longest is not None and width <= longest:
        here = starts.where((F.col("len") >= width) & (F.col("len") < 2 * width))
        named = _ahead(here.join(level, ["_uid", "seq"]), level, F.col("len") - F.lit(width))
        named = staged(named, "suffix-windows")
        interval = ["len", "rank", "next"]
        first = staged(named.groupBy(*interval).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "suffix-intervals")
        copies = named.join(first, interval).where(F.col("place") != F.col("first")).select("_uid", "seq", "len")
        found = copies if found is None else found.unionByName(copies)
        width *= 2
        if width <= longest:
            level = _doubled(level, width // 2)
    return found if found is not None else starts.select("_uid", "seq", "len").where(F.lit(False))


def removed_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(_uid, runs): per document with deletions, the maximal runs as sorted (seq, lines). ``docs`` is staged: _uid, doc_id, text."""
    windows = later_copies(repeated_lines(docs, min_words))
    lines = windows.select("_uid", F.explode(F.sequence(F.col("seq"), F.col("seq") + F.col("len") - 1)).alias("seq")).distinct()
    lines = lines.repartition("_uid")
    run = F.col("seq") - F.row_number().over(Window.partitionBy("_uid").orderBy("seq"))
    runs = lines.withColumn("run", run).groupBy("_uid", "run").agg(F.min("seq").alias("seq"), F.count(F.lit(1)).cast("int").alias("lines"))
    return runs.groupBy("_uid").agg(F.sort_array(F.collect_list(F.struct("seq", "lines"))).alias("runs"))


def _with_deletions(docs: DataFrame, min_words: int) -> DataFrame:
    """``docs`` (staged) with runs, and the text that is left."""
    joined = docs.join(removed_runs(docs.select("_uid", "doc_id", "text"), min_words), "_uid", "left")
    joined = joined.withColumn("runs", F.coalesce("runs", F.array().cast("array<struct<seq:int,lines:int>>")))
    joined = joined.withColumn("_numbers", F.transform(_lines(F.col("text")), lambda s: s["line"]))
    gone = F.flatten(F.transform("runs", lambda r: F.slice(F.col("_numbers"), r["seq"] + 1, r["lines"])))
    kept = F.array_except(F.sequence(F.lit(0), F.size(F.split("text", "\n")) - 1), gone)
    rest = F.array_join(F.transform(kept, lambda i: F.col("_split")[i]), "\n")
    joined = joined.withColumn("_split", F.split("text", "\n"))
    return joined.withColumn("_rest", F.when(F.size("runs") > 0, rest).otherwise(F.col("text")))


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated runs of lines cut out of ``text``; other columns and the rows stay."""
    rows = packed(docs, doc_id=F.col("doc_id"), text=F.col("text"))
    rows = staged(rows.withColumn("_uid", F.monotonically_increasing_id()), "line-docs")
    out = _with_deletions(rows, min_words).withColumn("_row", F.col("_row").withField("text", F.col("_rest")))
    return unpacked(out)


def deduplicated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, lines (non-blank), removed_lines, removed_runs, text_sha256 of what is left."""
    rows = staged(docs.select("doc_id", "text").withColumn("_uid", F.monotonically_increasing_id()), "line-docs")
    out = _with_deletions(rows, min_words)
    removed = F.aggregate("runs", F.lit(0), lambda total, r: total + r["lines"])
    return out.select(
        "doc_id", F.coalesce(F.size("_numbers"), F.lit(0)).alias("lines"), removed.alias("removed_lines"), F.size("runs").alias("removed_runs"),
        F.sha2(F.coalesce("_rest", F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )
