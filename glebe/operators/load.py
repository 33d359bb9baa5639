"""Insert-only registry load, set-at-a-time over all landing files at once.

Input is a *staging* DataFrame: ``file, pos`` (row order inside the file) plus
the six landing text columns and ``uf``. The reference processes files one by
one in sorted path order, each in its own transaction; the same result comes
from one plan where ``(file, pos)`` is a *value* that decides which row wins.

Plan shape (shuffles marked):
  staging ─► violation flags ─► groupBy(file) [tiny, map-side partial] ─► rejected files
  staging ⋉̸ rejected (one row per file, broadcast under a file-count bound) ─► good rows
  good ─► groupBy(key).count() [narrow, partial] ─► hashes of the keys with several rows
  good of these keys ─► groupBy(key).min(struct(file,pos,…)) [shuffle on key, map-side partial:
          a hot key collapses to one row per task before the exchange], the others as they are ─► first rows
  first rows ⋉̸ target keys [shuffle on key; only the key column of the target is read]
  good ─► groupBy(file,key).count() [narrow, partial] ─► per-file stats
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from glebe.functions import constants as C
from glebe.functions.text import clean_pct, pct_rejects_file
from glebe.operators.broadcast import MAX_BROADCAST_ROWS, bounded_broadcast
from glebe.session import staged
from glebe.sources.states import states_dim

# FIXED VALUES — rejection reasons, in the order they are tested per row.
REASONS = ["null_key", "matricula_too_long", "uf_too_long", "pct_not_storable", "unknown_uf"]
# Hashes of repeated keys that go to every task at most: about 40 bytes each in a task's table, 80 MB.
MOST_REPEATED = 2_000_000


def typed(staging: DataFrame) -> DataFrame:
    """K1: typed staging row — ``pct_obtencao`` cleaned to ``decimal(12,4)``, plus ``reason``:
    the first table constraint the row would break (NULL when none)."""
    known_uf = F.col("uf").isin(*[lbl.split(C.LABEL_SEPARATOR, 1)[0] for lbl in C.STATE_LABELS])
    reason = (
        F.when(F.col(C.KEY).isNull(), F.lit(REASONS[0]))
        .when(F.length("matricula") > C.MATRICULA_MAX_LEN, F.lit(REASONS[1]))
        .when(F.length("uf") > C.UF_MAX_LEN, F.lit(REASONS[2]))
        .when(pct_rejects_file("pct_obtencao"), F.lit(REASONS[3]))
        .when(F.col("uf").isNotNull() & ~known_uf, F.lit(REASONS[4]))
    )
    if "file_reason" in staging.columns:
        reason = F.coalesce(F.col("file_reason"), reason)
    out = staging.withColumn("reason", reason).withColumn("pct_obtencao", clean_pct("pct_obtencao"))
    return out.drop("file_reason")


def rejected_files(typed_rows: DataFrame) -> DataFrame:
    """Q1: one row per refused file with the reason of its first bad row and the bad-row count."""
    return (
        typed_rows.where(F.col("reason").isNotNull())
        .groupBy("file")
        .agg(F.min_by("reason", "pos").alias("reason"), F.count(F.lit(1)).alias("bad_rows"))
    )


def drop_rejected(typed_rows: DataFrame, rejected: DataFrame, max_files: int | None = None) -> DataFrame:
    """Remove the rows of refused files, without shuffling the rows by file (a file holding
    a third of the data would otherwise land in one task).

    The refused list has one row per file, so it is broadcast: directly when the caller
    knows a bound on the number of files (``max_files``, e.g. from the file listing),
    otherwise after a bounded count; beyond the bound the planner decides.
    """
    ref = rejected.select("file")
    if max_files is not None and max_files <= MAX_BROADCAST_ROWS:
        ref = F.broadcast(ref)
    else:
        ref = bounded_broadcast(ref)
    return typed_rows.join(ref, "file", "left_anti")


def accepted_rows(typed_rows: DataFrame, max_files: int | None = None) -> DataFrame:
    """Rows of files with no bad row (a file is one transaction)."""
    return drop_rejected(typed_rows, rejected_files(typed_rows), max_files)


def first_per_key(rows: DataFrame, order: list[str] | None = None, key: str = C.KEY) -> DataFrame:
    """One row per key, the first by ``order`` (default ``file, pos``).

    ``min`` over a struct led by the order columns is an aggregate with a map-side
    partial step, so duplicates of a hot key are cut to one per task before the shuffle.
    """
    order = order or ["file", "pos"]
    rest = [c for c in rows.columns if c != key and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    return rows.groupBy(key).agg(F.min(packed).alias("__first")).select(key, *[F.col("__first")[c].alias(c) for c in order + rest])


def first_rows(rows: DataFrame, order: list[str] | None = None, key: str = C.KEY, max_keys: int = MOST_REPEATED) -> DataFrame:
    """D1 over durable ``rows``, for keys that mostly occur once: the same rows as :func:`first_per_key`.

    One pass over the key column counts the rows of each key (a hash aggregate of narrow rows, cut per task). The
    hashes of the keys with several rows go to the tasks; a row whose hash is not among them is alone with its key and
    passes as it is, so only the rows of repeated keys are aggregated and shuffled whole. Where there are more
    repeated keys than ``max_keys``, or their rows are the greater part anyway, all rows are aggregated.
    """
    seen = Observation()
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.observe(seen, F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("keys"), F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("again"))
    repeated = staged(counts.where(F.col("n") > 1).select(F.xxhash64(key).alias("__hash")), "repeated-keys")
    total, keys, again = (seen.get[c] or 0 for c in ("rows", "keys", "again"))
    if not keys:
        return rows
    if keys > max_keys or 2 * again > total:
        return first_per_key(rows, order, key).select(*rows.columns)
    among = F.broadcast(repeated), F.xxhash64(rows[key]) == F.col("__hash")
    return rows.join(*among, "left_anti").unionByName(first_per_key(rows.join(*among, "left_semi"), order, key))


def new_rows(firsts: DataFrame, target_keys: DataFrame | None, key: str = C.KEY) -> DataFrame:
    """Rows whose key is not in the target yet (``LEFT JOIN … IS NULL`` = left anti)."""
    if target_keys is None:
        return firsts
    return firsts.join(target_keys.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def insert_only(staging: DataFrame, target_keys: DataFrame | None, max_files: int | None = None) -> DataFrame:
    """K2: the rows a load appends — accepted files, first row per key, keys not yet present.

    The typed rows are staged, so the source is read and parsed once for the refusals and the rows."""
    good = accepted_rows(staged(typed(staging), "typed"), max_files).drop("reason")
    return new_rows(first_rows(good), target_keys)


def count_existing(staging: DataFrame, target_keys: DataFrame, key: str = C.KEY) -> DataFrame:
    """Per file, distinct staged keys already in the target (a semi-join needs no
    dedupe of the target side, so the table's keys are only read, never aggregated)."""
    keys = staging.where(F.col(key).isNotNull()).select("file", key).distinct()
    hit = keys.join(target_keys.select(key), key, "left_semi")
    return hit.groupBy("file").agg(F.count(F.lit(1)).alias("ja_existiam"))


def load_summary(
    typed_rows: DataFrame, good: DataFrame, rejected: DataFrame, inserted: DataFrame, listed_files: DataFrame | None = None
) -> DataFrame:
    """A5: per file ``linhas_csv, codigos_unicos, novos, ja_existiam, linhas_inseridas, status, reason``.

    ``novos`` counts keys whose first occurrence over the sorted files is in this file
    and that were not in the target; ``ja_existiam`` is the rest of the file's distinct
    keys — what a file-by-file run reports (earlier files of the same run count as existing).
    All inputs are durable: ``typed_rows``, its ``good`` part, the ``rejected`` files and the rows ``inserted``
    by the run. ``listed_files`` adds header-only files as ``empty``. Counts come from ``(file, code)`` partials.
    """
    zero = [F.lit(0).cast("long").alias(c) for c in ["codigos_unicos", "novos", "ja_existiam", "linhas_inseridas"]]
    stats = (
        good.groupBy("file", C.KEY).agg(F.count(F.lit(1)).alias("n"))
        .groupBy("file").agg(F.sum("n").cast("long").alias("linhas_csv"), F.count(F.lit(1)).cast("long").alias("codigos_unicos"))
    )
    novos = inserted.groupBy("file").agg(F.count(F.lit(1)).cast("long").alias("novos"))
    none = F.lit(None).cast("string").alias("reason")
    loaded = stats.join(novos, "file", "left").select(
        "file", "linhas_csv", "codigos_unicos",
        F.coalesce("novos", F.lit(0)).cast("long").alias("novos"),
        (F.col("codigos_unicos") - F.coalesce("novos", F.lit(0))).cast("long").alias("ja_existiam"),
        F.coalesce("novos", F.lit(0)).cast("long").alias("linhas_inseridas"),
        F.lit("loaded").alias("status"), none,
    )
    read = typed_rows.groupBy("file").agg(F.count_if(F.col("pos") >= 0).cast("long").alias("linhas_csv"))
    refused = read.join(rejected, "file").select("file", "linhas_csv", *zero, F.lit("rejected").alias("status"), "reason")
    summary = loaded.unionByName(refused)
    if listed_files is not None:
        empty = listed_files.select("file").distinct().join(read.select("file"), "file", "left_anti").select(
            "file", F.lit(0).cast("long").alias("linhas_csv"), *zero, F.lit("empty").alias("status"), none,
        )
        summary = summary.unionByName(empty)
    return summary


def run_summary(manifest: DataFrame) -> DataFrame:
    """The number of files per status, and one row for each file that failed, with its reason."""
    totals = manifest.groupBy("status").agg(F.count(F.lit(1)).alias("files"))
    none = F.lit(None).cast("string")
    failed = manifest.where(F.col("status") == "rejected")
    return totals.select("status", "files", none.alias("file"), none.alias("reason")).unionByName(
        failed.select("status", F.lit(1).cast("long").alias("files"), "file", "reason")
    )


def file_status(staging: DataFrame, listed_files: DataFrame | None = None) -> DataFrame:
    """Manifest ``(file, status, reason)`` of a run; ``listed_files`` adds header-only files as ``empty``."""
    t = typed(staging)
    rej = rejected_files(t).select("file", F.lit("rejected").alias("status"), "reason")
    seen = t.select("file").distinct()
    ok = seen.join(rej, "file", "left_anti").select("file", F.lit("loaded").alias("status"), F.lit(None).cast("string").alias("reason"))
    out = ok.unionByName(rej)
    if listed_files is not None:
        empty = listed_files.select("file").join(seen, "file", "left_anti").select(
            "file", F.lit("empty").alias("status"), F.lit(None).cast("string").alias("reason")
        )
        out = out.unionByName(empty)
    return out


def fk_violations(rows: DataFrame, spark: SparkSession) -> DataFrame:
    """Rows whose non-null ``uf`` is not a known state (NULL passes the foreign key)."""
    return rows.where(F.col("uf").isNotNull()).join(states_dim(spark).select("uf"), "uf", "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q4: keys occurring more than once, with their count (empty when the key is unique)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def duplicate_state_names(states: DataFrame) -> DataFrame:
    """Q8: state names that occur more than once (the table has them unique)."""
    return duplicate_keys(states, ["name"])


def deletable_states(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """Q8: states no fact row refers to (``ON DELETE RESTRICT`` lets only these go).

    The fact side is first reduced to its distinct states (map-side partial aggregate),
    so a state holding a third of the rows never sends them all to one task."""
    used = fact.select("uf").where(F.col("uf").isNotNull()).distinct()
    return states_dim(spark).join(used, "uf", "left_anti")


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """K9: what remains after ``DELETE … WHERE predicate``; a NULL predicate keeps the row."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def drop_column_if_exists(df: DataFrame, name: str) -> DataFrame:
    """K7: ``ALTER TABLE … DROP COLUMN IF EXISTS``."""
    return df.drop(name) if name in df.columns else df
