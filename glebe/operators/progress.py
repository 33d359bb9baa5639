"""Acquisition bookkeeping as DataFrame operators.

The reference keeps these in Python sets and loops on one machine; here each
is a set operation over distributed rows: selections are array expressions,
"skip what is done" is a left-anti join, matching is an equi-join per tier,
retry status is a two-step aggregate (map-side partial, no window sort).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glebe.functions import constants as C
from glebe.functions.text import norm_key, py_strip, uf_from_label
from glebe.operators.broadcast import bounded_broadcast
from glebe.sources.states import states_dim


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- selections ---------------------------------------------------------------

def parse_state_list(text) -> Column:
    """``{x.strip().upper() for x in s.split(',') if x.strip()}`` as a sorted array."""
    items = F.transform(F.split(_c(text), ",", -1), lambda x: F.upper(py_strip(x)))
    return F.array_sort(F.array_distinct(F.filter(items, lambda x: x != "")))


def parse_numeric_selection(choice, items: list[str] | None = None) -> Column:
    """P10: 1-based picks into ``items`` → sorted distinct UF codes; NULL means "all".

    Blank input, or no valid pick (non-numbers and out-of-range are ignored), gives NULL.
    ``items`` defaults to the state list and becomes a literal array (no join needed).
    """
    items = items or C.STATE_LABELS
    arr = F.array(*[F.lit(x) for x in items])
    idx = F.transform(
        F.filter(F.transform(F.split(_c(choice), ",", -1), lambda x: py_strip(x)), lambda x: x != ""),
        lambda x: x.try_cast("int"),
    )
    ok = F.filter(idx, lambda i: i.between(1, len(items)))
    codes = F.array_sort(F.array_distinct(F.transform(ok, lambda i: F.upper(F.substring_index(F.element_at(arr, i), C.LABEL_SEPARATOR, 1)))))
    return F.when(F.size(codes) > 0, codes)


def selectable_options(options: DataFrame, text_col: str = "text", value_col: str = "value", ignore_case: bool = False) -> DataFrame:
    """Drop placeholder options (no value, ``Selecione`` in the text, empty text).

    ``ignore_case``: the form for the live list, which also drops ``SELECIONE`` and the like."""
    t, v = F.col(text_col), F.col(value_col)
    placeholder = F.lower(t).contains(C.PLACEHOLDER_OPTION.lower()) if ignore_case else t.contains(C.PLACEHOLDER_OPTION)
    return options.where(v.isNotNull() & (v != "") & t.isNotNull() & ~placeholder & (t != ""))


def filter_selected_options(options: DataFrame, selected: DataFrame, text_col: str = "text", code_col: str = "code") -> DataFrame:
    """Keep options whose upper-cased label, or its prefix before `` - ``, is selected.

    Two equi-joins against the (distinct, size-checked, broadcast) selection instead of
    one OR-join; neither join can multiply rows, and the option list is never shuffled.
    """
    sel = bounded_broadcast(selected.select(F.col(code_col).alias("__k")).distinct())
    full = F.upper(F.col(text_col))
    prefix = F.upper(F.substring_index(F.col(text_col), C.LABEL_SEPARATOR, 1))
    a = sel.select(F.col("__k").alias("__k1"))
    b = sel.select(F.col("__k").alias("__k2"))
    o = options.join(a, full == F.col("__k1"), "left").join(b, prefix == F.col("__k2"), "left")
    return o.where(F.col("__k1").isNotNull() | F.col("__k2").isNotNull()).drop("__k1", "__k2")


# --- labels and matching -------------------------------------------------------

def label_with_default(spark: SparkSession, codes: DataFrame, code_col: str = "uf") -> DataFrame:
    """``state_label_map.get(uf, uf)`` — broadcast left join to the 27-row dimension."""
    st = states_dim(spark).select(F.col("uf").alias("__uf"), F.col("label").alias("__label"))
    return codes.join(st, F.col(code_col) == F.col("__uf"), "left").withColumn(
        "label", F.coalesce(F.col("__label"), F.col(code_col))
    ).drop("__uf", "__label")


def _prefixes(text: Column) -> Column:
    """Every part of a text that `` -`` follows."""
    pieces = F.split(text, " -", -1)
    cut = F.transform(F.sequence(F.lit(1), F.size(pieces) - 1), lambda k: F.array_join(F.slice(pieces, F.lit(1), k), " -"))
    return F.when(F.size(pieces) > 1, cut).otherwise(F.array().cast("array<string>"))


def _best(candidates: DataFrame) -> DataFrame:
    best = candidates.groupBy("uf").agg(F.min(F.struct("tier", "ord", "value")).alias("b"))
    return best.select("uf", F.col("b.tier").alias("tier"), F.col("b.ord").alias("ord"), F.col("b.value").alias("value"))


def _keyed(tier: int, kind: str, key: Column) -> Column:
    return F.struct(F.lit(tier).alias("tier"), F.lit(kind).alias("kind"), key.alias("key"))


def tiered_match(wanted: DataFrame, options: DataFrame) -> DataFrame:
    """Pick one option per wanted ``(uf, label)``.

    Tier 0: option value equals the UF; tier 1: option text starts with ``UF -``;
    tier 2: option text equals the label. All comparisons accent- and
    case-insensitive on trimmed text; the first option (``ord``) of the lowest tier wins.
    One pass over the options: each gives the folded keys of all its tiers (tier 1: every prefix of the text
    that is followed by `` -``), hash-joined with the size-checked, broadcast wanted list.
    """
    wanted_keys = F.array(
        F.struct(F.lit("uf").alias("kind"), norm_key("uf").alias("key")), F.struct(F.lit("label").alias("kind"), norm_key("label").alias("key"))
    )
    w = bounded_broadcast(wanted.select("uf", F.inline(wanted_keys)))
    texts = options.select("ord", "value", norm_key("value").alias("__v"), norm_key("text").alias("__t"))
    keys = F.concat(
        F.array(_keyed(0, "uf", F.col("__v")), _keyed(2, "label", F.col("__t"))),
        F.transform(_prefixes(F.col("__t")), lambda p: _keyed(1, "uf", p)),
    )
    return _best(texts.select("ord", "value", F.inline(keys)).join(w, ["kind", "key"]))


def candidate_match(wanted: DataFrame, options: DataFrame) -> DataFrame:
    """Pick one option per wanted ``(uf, opt_value)``: its value equals the wanted value (tier 0), else the UF
    code (tier 1), both exactly as written, before any folding."""
    candidates = F.array(
        F.struct(F.lit(0).alias("tier"), F.col("opt_value").alias("key")), F.struct(F.lit(1).alias("tier"), F.col("uf").alias("key"))
    )
    w = bounded_broadcast(wanted.select("uf", F.inline(candidates)))
    return _best(options.select("ord", "value").join(w, F.col("value") == F.col("key")))


# --- checkpoint and retries --------------------------------------------------------

def pending_tasks(tasks: DataFrame, completed: DataFrame, label_col: str = "state") -> DataFrame:
    """Tasks whose label is not in the completed set."""
    return tasks.join(completed.select(label_col).distinct(), label_col, "left_anti")


def valid_completed(completed: DataFrame, files: DataFrame, label_col: str = "state") -> DataFrame:
    """Keep completed labels whose expected output file exists and is non-empty.

    ``files`` is a listing ``(file_name, length)``; expected name is ``file_name``
    column of ``completed``.
    """
    ok = files.where(F.col("length") > 0).select("file_name")
    return completed.join(ok, "file_name", "left_semi")


def save_checkpoint(completed: DataFrame, path: str, label_col: str = "state") -> None:
    """Write the completed set, sorted and distinct, to a fresh directory (never in place)."""
    columns = [label_col, *[c for c in completed.columns if c == "file_name"]]
    completed.select(*columns).dropDuplicates([label_col]).orderBy(label_col).write.mode("errorifexists").parquet(path)


def load_checkpoint(spark: SparkSession, path: str | None, columns: str = "state string") -> DataFrame:
    """Read a saved completed set; a missing checkpoint is an empty set (reset = new path). Any other fault is raised."""
    if path:
        try:
            return spark.read.schema(columns).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], columns)


def resume(spark: SparkSession, path: str | None, files: DataFrame, new_path: str) -> DataFrame:
    """The completed set of a checkpoint, without the labels whose file is missing or empty by now; it is
    saved to ``new_path`` and read from there. ``files`` is a listing ``(file_name, length)``."""
    valid = valid_completed(load_checkpoint(spark, path, "state string, file_name string"), files)
    save_checkpoint(valid, new_path)
    return load_checkpoint(spark, new_path, "state string, file_name string")


# Tasks that share the attempts of one state.
SALTS = 16


def retry_status(attempts: DataFrame, max_rounds: int = 3, state_col: str = "state", order_col: str = "ts") -> DataFrame:
    """Per state, rounds used and final status under ``max_rounds`` rounds.

    A state is retried until its first successful attempt (``success`` and a file of non-zero ``size``; its
    records may be 0 or uncounted); attempts after ``max_rounds`` never happen. Two aggregates with map-side
    partial steps: first successful time per state, then the count of attempts up to it. The attempts meet the
    first success on ``(state, salt)``, so a state with a third of all attempts is shared by SALTS tasks.
    """
    ok = F.col("success") & (F.col("size") > 0)
    first_ok = attempts.groupBy(state_col).agg(
        F.min(F.when(ok, F.col(order_col))).alias("__first_ok"), F.count(F.lit(1)).alias("attempts")
    )
    every_salt = first_ok.withColumn("__salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    salted = attempts.select(state_col, order_col, F.pmod(F.xxhash64(order_col), F.lit(SALTS)).cast("int").alias("__salt"))
    before = F.col("__first_ok").isNull() | (F.col(order_col) <= F.col("__first_ok"))
    upto = salted.join(every_salt, [state_col, "__salt"]).where(before).groupBy(state_col, "__salt").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__first_ok").alias("__first_ok"), F.min("attempts").alias("attempts")
    )
    upto = upto.groupBy(state_col).agg(F.sum("__n").alias("__n"), F.min("__first_ok").alias("__first_ok"), F.min("attempts").alias("attempts"))
    done_round = F.when(F.col("__first_ok").isNotNull(), F.col("__n"))
    return upto.select(
        state_col,
        F.col("attempts").cast("long").alias("attempts"),
        done_round.cast("long").alias("success_round"),
        F.least(F.coalesce(done_round, F.col("__n")), F.lit(max_rounds)).cast("long").alias("rounds_used"),
        F.when(done_round <= max_rounds, F.lit("done")).otherwise(F.lit("failed")).alias("status"),
    )


__all__ = [
    "candidate_match", "filter_selected_options", "label_with_default", "load_checkpoint", "parse_numeric_selection", "parse_state_list",
    "pending_tasks", "resume", "retry_status", "save_checkpoint", "selectable_options", "tiered_match", "uf_from_label",
    "valid_completed",
]
