"""The registry table on Parquet: layout, reads, and the insert-only load job.

Layout (L1): ``<table>/load_run=<id>/uf=<UF>/part-*.parquet``. Each load writes its own ``load_run`` folder. Inside it,
rows are range-partitioned on ``(uf, codigo_incra)`` and sorted, so Parquet row-group min/max statistics on the key are
tight and a lookup by code skips nearly every row group; a bloom filter on the key does the rest. Partition pruning on
``uf`` is free. Beside the folder stand its key filter (``_keys/``) and the statistics of its files (``_files/``).

Commits: a folder becomes part of the table when a version of the commit log lists it (:mod:`glebe.operators.commits`).
A load compares its codes with one version; before it commits the next, it compares them with whatever was committed
in between, so a code enters the table once even if loads overlap. A failed run leaves nothing readers see, and a
rerun appends nothing.

Known codes are found without reading the table's keys: a code outside a part's range, or not in its key filter, is
certainly not there, and only parts that may hold a code are opened, for their key column.

The job cuts lineage in the shared checkpoint folder: the typed staging (read by quarantine, dedupe and the summary),
the first rows of each code, and the rows to insert. An executor lost at any point recomputes from durable files,
never from a half-written table.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glebe.functions import constants as C
from glebe.operators import commits, key_filter
from glebe.operators import load as L
from glebe.operators.commits import Part, Version
from glebe.session import scratch_path, staged
from glebe.sources import fs
from glebe.sources.states import states_dim

SUMMARY_DIR = "_load_summary"  # leading underscore: ignored by readers of the table itself
# Target rows per output partition of a load run (sizes files at ~128 MB for registry rows).
ROWS_PER_PARTITION = 1_000_000


# Columns a reader of the table sees: the table schema plus the partition columns. Reading with
# it (instead of inferring from file footers) fixes the schema across runs and drops obsolete
# columns that older files may still carry (K7 at table level).
REGISTRY_SCHEMA = (
    "codigo_incra string, matricula string, municipio string, denominacao string, proprietario string, "
    "pct_obtencao decimal(12,4), loaded_at timestamp_ntz, load_run string, uf string"
)


def read_registry(spark: SparkSession, table: str) -> DataFrame | None:
    """The table in its latest version, or ``None`` while it has no run. What no version lists is left out."""
    version = commits.current(spark, table)
    if not version.number and not version.parts and not _has_runs(spark, table):
        return None
    return read_parts(spark, table, version.parts)


def read_parts(spark: SparkSession, table: str, parts: tuple[Part, ...] | list[Part]) -> DataFrame:
    """The rows of some parts of the table."""
    paths = []
    for p in parts:
        paths += [f"{table}/{p.folder}"] if p.ufs is None else [f"{table}/{p.folder}/uf={uf or NULL_STATE}" for uf in p.ufs]
    return _read_paths(spark, table, paths)


# The folder of rows without a state.
NULL_STATE = "__HIVE_DEFAULT_PARTITION__"


def _read_paths(spark: SparkSession, table: str, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], REGISTRY_SCHEMA)
    rows = spark.read.schema(REGISTRY_SCHEMA).option("basePath", fs.qualified(spark, table)).parquet(*paths)
    if any("+" in p.rsplit("load_run=", 1)[-1] for p in paths):  # folders of a later attempt or of a rewrite
        rows = rows.withColumn("load_run", F.regexp_replace("load_run", r"\+\d+$", ""))
    return rows


def _has_runs(spark: SparkSession, table: str) -> bool:
    return any(p.rstrip("/").split("/")[-1].startswith("load_run=") for p in fs.list_dirs(spark, table))


# --- what is known about the files of a part --------------------------------------------------

FILES_DIR = "_files"
FILES_SCHEMA = "folder string, file string, uf string, rows long, low string, high string, null_codes long, null_pct long, no_owner long, no_status long"


def _write_file_stats(spark: SparkSession, table: str, folder: str) -> DataFrame:
    """One row per file of a part: its states' rows, range of codes and the counts that quality checks add up (four columns are read)."""
    rows = _read_paths(spark, table, [f"{table}/{folder}"])
    file = F.regexp_extract(F.col("_metadata.file_path"), r"/(load_run=[^/]*/[^?]*)$", 1)
    empty = lambda c: F.col(c).isNull() | (F.col(c) == "")
    stats = rows.groupBy(F.lit(folder).alias("folder"), file.alias("file"), "uf").agg(
        F.count(F.lit(1)).alias("rows"), F.min(C.KEY).alias("low"), F.max(C.KEY).alias("high"), F.count_if(F.col(C.KEY).isNull()).alias("null_codes"),
        F.count_if(F.col("pct_obtencao").isNull()).alias("null_pct"), F.count_if(empty("proprietario")).alias("no_owner"), F.count_if(empty("denominacao")).alias("no_status"),
    )
    path = f"{table}/{FILES_DIR}/{folder}"
    stats.coalesce(1).write.parquet(path)  # a row per file, already reduced
    return spark.read.schema(FILES_SCHEMA).parquet(path)


def file_stats(spark: SparkSession, table: str) -> DataFrame | None:
    """Statistics of all files of the latest version (:data:`FILES_SCHEMA`); None if a part has none."""
    parts = commits.current(spark, table).parts
    if any(not p.blocks for p in parts):
        return None
    if not parts:
        return spark.createDataFrame([], FILES_SCHEMA)
    stats = spark.read.schema(FILES_SCHEMA).parquet(*[f"{table}/{FILES_DIR}/{p.folder}" for p in parts])
    for p in parts:
        if p.ufs is not None:
            live = F.lit(False)
            for uf in p.ufs:
                live = live | F.col("uf").eqNullSafe(F.lit(uf))
            stats = stats.where((F.col("folder") != p.folder) | live)
    return stats


def read_files(spark: SparkSession, table: str, files: list[str]) -> DataFrame:
    """The rows of some files of the table, named as in :func:`file_stats`."""
    paths = []
    for f in files:
        path = unquote(f)
        for ch in "\\{}[]*?":
            path = path.replace(ch, "\\" + ch)
        paths.append(f"{table}/{path}")
    return _read_paths(spark, table, paths)


# --- codes the table has ------------------------------------------------------------------------


def existing_codes(spark: SparkSession, table: str, parts: tuple[Part, ...] | list[Part], codes: DataFrame) -> DataFrame | None:
    """Of ``codes`` (staged, column codigo_incra, each once), those that the parts hold; None if certainly none.

    Parts whose range lies off the codes are left out without a look; of the others, only those whose filter
    admits a code are opened, and only the admitted codes meet their key column."""
    ends = codes.agg(F.min(C.KEY).alias("low"), F.max(C.KEY).alias("high")).first()
    if ends["low"] is None:
        return None
    near = [p for p in parts if p.low is None or (p.low <= ends["high"] and ends["low"] <= p.high)]
    unknown = [p for p in near if not p.blocks]
    filtered = [p for p in near if p.blocks]
    opened, wanted = list(unknown), codes.select(C.KEY) if unknown else None
    if filtered:
        maybe = staged(key_filter.possible(codes.select(C.KEY), table, filtered), "possible")
        hit = {r["folder"] for r in maybe.select("folder").distinct().collect()}  # names of parts
        opened += [p for p in filtered if p.folder in hit]
        wanted = maybe.select(C.KEY).distinct() if wanted is None else wanted
    if not opened:
        return None
    return read_parts(spark, table, opened).select(C.KEY).join(wanted, C.KEY, "left_semi")


def rows_not_in(spark: SparkSession, table: str, parts: tuple[Part, ...] | list[Part], firsts: DataFrame) -> DataFrame:
    """Of ``firsts`` (staged, one row per code) those whose code the parts do not hold."""
    there = existing_codes(spark, table, parts, firsts)
    return firsts if there is None else L.new_rows(firsts, staged(there, "existing"))


def count_existing(spark: SparkSession, table: str, staging: DataFrame) -> DataFrame:
    """Per file, distinct staged codes that the table has."""
    keys = staged(staging.where(F.col(C.KEY).isNotNull()).select("file", C.KEY).distinct(), "staged-codes")
    there = existing_codes(spark, table, commits.current(spark, table).parts, staged(keys.select(C.KEY).distinct(), "codes"))
    if there is None:
        return spark.createDataFrame([], "file string, ja_existiam long")
    return L.count_existing(keys, there)


def _write_part(spark: SparkSession, table: str, run: str, rows: DataFrame, count: int, rows_per_task: int | None = None) -> Part:
    """Write rows as a folder of the table, with its key filter and file statistics; no version lists it yet."""
    folder = commits.claim_folder(spark, table, run)
    write_layout(rows, f"{table}/{folder}", count, rows_per_task=rows_per_task)
    blocks = key_filter.blocks_for(count)
    written = _read_paths(spark, table, [f"{table}/{folder}"])
    with ThreadPoolExecutor(2) as both:  # two jobs over the written folder, side by side
        stats = both.submit(_write_file_stats, spark, table, folder)
        keys = both.submit(key_filter.write_filter, written.select(C.KEY), f"{table}/{key_filter.KEYS_DIR}/{folder}", folder, blocks)
        keys.result()
        stats = stats.result().agg(F.sum("rows").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).first()
    return Part(folder, run, stats["n"], stats["low"], stats["high"], blocks)


def publish(spark: SparkSession, table: str, run: str, new: DataFrame, seen: Version, rows_per_task: int | None = None) -> DataFrame:
    """Commit ``new`` (durable rows, one per code, none of them in version ``seen``) and return what was committed.

    Other loads may have committed since: codes that they brought are taken out first. If one commits between that
    and our own commit, the folder is written again without its codes."""
    while True:
        now = commits.current(spark, table)
        before = {p.folder for p in seen.parts}
        later = [p for p in now.parts if p.folder not in before]
        if later:
            new = staged(rows_not_in(spark, table, later, new), "still-new")
        seen, count = now, new.count()
        if not count:
            return new
        out = new.select(*C.TABLE_COLUMNS).withColumn("loaded_at", F.localtimestamp())
        part = _write_part(spark, table, run, out, count, rows_per_task)
        if commits.commit(spark, table, now, (*now.parts, part)):
            return new
        fs.delete(spark, f"{table}/{part.folder}")  # our own; no version lists it


def _partitions(rows: int, rows_per_task: int) -> int:
    return max(1, -(-rows // rows_per_task))


def write_layout(
    rows: DataFrame, path: str, count: int, by: tuple[str, ...] = ("uf", C.KEY), partition_by: str | None = "uf", rows_per_task: int | None = None,
) -> None:
    """L1: range-partition and sort on ``by``, ``partitionBy('uf')``, bloom filter on the last column of ``by``.

    Range partitioning (sampled) keeps every task's key range contiguous and
    splits a state holding a third of the rows over many tasks. ``count`` (the number of rows) sets the
    number of tasks and the size of the bloom filters.
    """
    n = _partitions(count, rows_per_task or ROWS_PER_PARTITION)
    key = by[-1]
    writer = rows.repartitionByRange(n, *by).sortWithinPartitions(*by).write.options(**{
        f"parquet.bloom.filter.enabled#{key}": "true",
        f"parquet.bloom.filter.expected.ndv#{key}": str(max(1, -(-count // n))),
        "compression": "zstd",
    })
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_index(registry: DataFrame, path: str, column: str) -> DataFrame:
    """L1: a second copy of the table sorted by another column (``municipio``, ``proprietario``), so that an
    equality on it reads the row groups that hold the value and no others."""
    rows = registry.drop("load_run")
    write_layout(rows, path, rows.count(), by=(column,), partition_by=None)
    return registry.sparkSession.read.schema(rows.schema).parquet(path)


SUMMARY_SCHEMA = (
    "file string, linhas_csv long, codigos_unicos long, novos long, ja_existiam long, linhas_inseridas long, "
    "status string, reason string, run_id string"
)


@dataclass
class LoadResult:
    run_id: str
    inserted: int
    summary: DataFrame  # per file: linhas_csv, codigos_unicos, novos, ja_existiam, linhas_inseridas, status, reason


@dataclass
class PreparedLoad:
    """A load up to its commit: durable tables and the version they were compared with."""

    run_id: str
    work: str
    staged: DataFrame
    good: DataFrame
    rejected: DataFrame
    new: DataFrame
    seen: Version
    listed_files: DataFrame | None


def prepare_load(
    spark: SparkSession, staging: DataFrame, table: str, run_id: str | None = None, listed_files: DataFrame | None = None, max_files: int | None = None,
) -> PreparedLoad:
    """Stage (typed, durable) → quarantine → first row per key → the rows whose codes the table does not have."""
    run_id = run_id or uuid.uuid4().hex[:12]
    work = scratch_path(spark, f"load-{run_id}")

    L.typed(staging).write.parquet(f"{work}/staged")
    typed = spark.read.parquet(f"{work}/staged")
    rejected = L.rejected_files(typed)
    good = L.drop_rejected(typed, rejected, max_files).drop("reason")
    firsts = L.first_rows(good)
    seen = commits.current(spark, table)
    if seen.parts:  # the codes are compared with the parts and then joined: once computed, once written
        firsts.write.parquet(f"{work}/firsts")
        firsts = spark.read.parquet(f"{work}/firsts")
        firsts = rows_not_in(spark, table, seen.parts, firsts)
    firsts.write.parquet(f"{work}/new")
    return PreparedLoad(run_id, work, typed, good, rejected, spark.read.parquet(f"{work}/new"), seen, listed_files)


def finish_load(spark: SparkSession, load: PreparedLoad, table: str, rows_per_task: int | None = None) -> LoadResult:
    """Commit a prepared load and write its summary next to the table."""
    committed = publish(spark, table, load.run_id, load.new, load.seen, rows_per_task)
    summary = L.load_summary(load.staged, load.good, load.rejected, committed, load.listed_files).withColumn("run_id", F.lit(load.run_id))
    summary_path = f"{table}/{SUMMARY_DIR}/load_run={load.run_id}"
    summary.write.parquet(summary_path)
    inserted = committed.count()
    fs.delete(spark, load.work)  # a copy of the whole input; nothing refers to it any more
    return LoadResult(load.run_id, inserted, spark.read.parquet(summary_path))


def run_load(
    spark: SparkSession,
    staging: DataFrame,
    table: str,
    run_id: str | None = None,
    listed_files: DataFrame | None = None,
    max_files: int | None = None,
    rows_per_task: int | None = None,
) -> LoadResult:
    """K2/K3/A5: load staged rows into ``table`` insert-only and record the per-file summary.

    ``listed_files`` (a ``file`` column) adds files without data rows to the summary as ``empty``; ``max_files`` is a
    known bound on the number of input files (from the listing); ``rows_per_task`` sizes the files
    (:data:`ROWS_PER_PARTITION` unless given). Loads may overlap: a code is committed once.
    """
    return finish_load(spark, prepare_load(spark, staging, table, run_id, listed_files, max_files), table, rows_per_task)


def insert_only(spark: SparkSession, table: str, staging: DataFrame, max_files: int | None = None) -> DataFrame:
    """K2: the rows that a load into ``table`` would append (nothing is committed)."""
    good = L.accepted_rows(staged(L.typed(staging), "typed"), max_files).drop("reason")
    firsts = staged(L.first_rows(good), "firsts")
    return rows_not_in(spark, table, commits.current(spark, table).parts, firsts)


def load_directory(spark: SparkSession, directory: str, table: str, run_id: str | None = None) -> LoadResult:
    """Load every ``*.csv`` of a landing directory into ``table`` (header-only files reported as ``empty``)."""
    from glebe.sources import landing

    if not fs.exists(spark, directory):
        return LoadResult(run_id or "none", 0, spark.createDataFrame([], SUMMARY_SCHEMA))
    listing = landing.list_csv(spark, directory).where(F.col("length") > 0)
    n_files = listing.count()  # the bound for broadcasting per-file lists
    if not n_files and not landing.unlisted_csv(spark, directory):  # nothing landed: the run leaves no trace
        return LoadResult(run_id or "none", 0, spark.createDataFrame([], SUMMARY_SCHEMA))
    return run_load(spark, landing.read_landing(spark, directory), table, run_id=run_id, listed_files=listing, max_files=n_files)


def delete_rows(spark: SparkSession, table: str, predicate, new_table: str) -> DataFrame:
    """K9: ``DELETE FROM table WHERE predicate`` as a rewrite into ``new_table`` (a new version;
    the old one is never overwritten while it is being read). NULL predicates keep the row."""
    current = read_registry(spark, table)
    if current is None:
        raise ValueError(f"no committed run under {table}")
    kept = L.delete_where(current, predicate)
    _write_version(spark, new_table, "rewrite", kept)
    return read_registry(spark, new_table)


def _write_version(spark: SparkSession, table: str, run: str, rows: DataFrame) -> None:
    """Commit rows that hold each code once as the only part of a table."""
    version = commits.current(spark, table)
    count = rows.count()
    parts = (_write_part(spark, table, run, rows.drop("load_run"), count),) if count else ()
    if version.parts or not commits.commit(spark, table, version, parts):
        raise ValueError(f"{table} is in use")


def delete_from(spark: SparkSession, table: str, predicate) -> int:
    """K9: ``DELETE FROM table WHERE predicate`` in place; returns the number of rows deleted.

    One scan (the predicate reaches it) finds the state folders that hold matches. These are written anew without
    them, one folder per run, and the next version lists the new folders for these states and the old ones for all
    others, whose files are not touched. A NULL predicate keeps the row. A delete sees the version it began with: rows
    of loads that commit meanwhile stay. If one of its own folders was rewritten meanwhile, it starts over."""
    matched = F.coalesce(predicate, F.lit(False))
    while True:
        now = commits.current(spark, table)
        gone, renewed = 0, {}
        for part in now.parts:  # one job for each part that the scan does not rule out
            rows = read_parts(spark, table, [part])
            hit = {r["uf"]: r["n"] for r in rows.where(matched).groupBy("uf").agg(F.count(F.lit(1)).alias("n")).collect()}  # states
            if not hit:
                continue
            gone += sum(hit.values())
            states = [r["uf"] for r in rows.select("uf").distinct().collect()]
            touched = rows.where(F.coalesce(F.col("uf").isin([u for u in hit if u is not None]), F.lit(False)) | (F.col("uf").isNull() & F.lit(None in hit)))
            kept = staged(touched.where(~matched).drop("load_run"), "kept")
            count = kept.count()
            fresh = _write_part(spark, table, part.run, kept, count) if count else None
            renewed[part.folder] = [p for p in (commits.without_states(part, set(hit), states), fresh) if p is not None]
        if not renewed:
            return 0
        latest = now
        while {p.folder: p for p in now.parts if p.folder in renewed}.items() <= {p.folder: p for p in latest.parts}.items():
            parts = tuple(q for p in latest.parts for q in renewed.get(p.folder, [p]))
            if commits.commit(spark, table, latest, parts):
                return gone
            latest = commits.current(spark, table)


# --- catalog tables ---------------------------------------------------------------------------

DDL_COLUMNS = (
    "codigo_incra STRING, matricula STRING, municipio STRING, denominacao STRING, "
    "proprietario STRING, pct_obtencao DECIMAL(12,4), loaded_at TIMESTAMP_NTZ, load_run STRING, uf STRING"
)


def create_schema(spark: SparkSession, registry: str, location: str, states: str, states_location: str) -> None:
    """K6/K5: ``CREATE TABLE IF NOT EXISTS`` the registry (the path layout of :func:`run_load` as an external
    table) and the states dimension, which is seeded when empty. Call :func:`refresh_schema` after loads."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {registry} ({DDL_COLUMNS}) USING parquet PARTITIONED BY (load_run, uf) LOCATION '{location}'")
    seed_if_empty(spark, states_dim(spark), states_location)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {states} (pos INT, uf STRING, name STRING, label STRING) USING parquet LOCATION '{states_location}'")


def refresh_schema(spark: SparkSession, registry: str) -> None:
    """Make the catalog show the latest version: partitions of new parts are added, those of replaced ones dropped."""
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {registry}").where("col_name = 'Location'").first()["data_type"]
    version = commits.current(spark, location)
    wanted = {}
    for part in version.parts:
        found = [d.rstrip("/").rsplit("/", 1)[-1] for d in fs.list_dirs(spark, f"{location}/{part.folder}")]
        for name in found:
            uf = None if name == f"uf={NULL_STATE}" else unquote(name.removeprefix("uf="))
            if name.startswith("uf=") and (part.ufs is None or uf in part.ufs):
                # a rewritten folder keeps its own name here, as a run may then have two folders for different states
                wanted[part.folder.removeprefix("load_run="), uf] = f"{location}/{part.folder}/{name}"
    shown = {}
    for r in spark.sql(f"SHOW PARTITIONS {registry}").collect():
        run, uf = (unquote(x.split("=", 1)[1]) for x in r[0].split("/"))
        shown[run, None if uf == NULL_STATE else uf] = r[0]
    text = lambda x: "null" if x is None else "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spec = lambda key: f"(load_run={text(key[0])}, uf={text(key[1])})"
    for key in shown.keys() - wanted.keys():
        spark.sql(f"ALTER TABLE {registry} DROP IF EXISTS PARTITION {spec(key)}")
    added = [f"PARTITION {spec(k)} LOCATION {text(wanted[k])}" for k in sorted(wanted.keys() - shown.keys(), key=repr)]
    for at in range(0, len(added), 100):
        spark.sql(f"ALTER TABLE {registry} ADD IF NOT EXISTS " + " ".join(added[at:at + 100]))


def compact(spark: SparkSession, table: str, new_table: str) -> DataFrame:
    """Rewrite every committed run of ``table`` as one run of ``new_table`` (same layout:
    range-partitioned on ``(uf, code)``, sorted, bloom filter). Incremental loads and
    stream micro-batches each add a run; compaction keeps listing and footer reads flat.
    The old version is left in place — readers switch by path."""
    current = read_registry(spark, table)
    if current is None:
        raise ValueError(f"no committed run under {table}")
    _write_version(spark, new_table, "compacted", current)
    return read_registry(spark, new_table)


def read_summaries(spark: SparkSession, table: str) -> DataFrame:
    """Every run's per-file summary (``load_run`` from the directory name)."""
    return spark.read.option("basePath", f"{table}/{SUMMARY_DIR}").parquet(f"{table}/{SUMMARY_DIR}/load_run=*")


def seed_if_empty(spark: SparkSession, rows: DataFrame, path: str) -> bool:
    """K5: append ``rows`` only when the table at ``path`` has none. Returns whether it seeded."""
    if fs.exists(spark, path) and not spark.read.parquet(path).isEmpty():
        return False
    rows.write.mode("append").parquet(path)
    return True


def insert_on_conflict_skip(rows: DataFrame, existing_keys: DataFrame | None, key: str, order: list[str]) -> DataFrame:
    """K4: ``INSERT … ON CONFLICT (key) DO NOTHING`` — the rows that get in.

    Within one statement the first row of a key (by ``order``) wins and later ones
    conflict with it; keys already present conflict with the table.
    """
    return L.new_rows(L.first_per_key(rows, order=order, key=key), existing_keys, key=key)
