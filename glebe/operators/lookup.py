"""Lookups by property code: one key or a batch of keys, same plan.

A batch of requested keys is validated (P5), matched against the registry,
classified found / not_found / invalid (Q6) and shaped into the response record
(R4). A key batch that passes a size check is broadcast and the table is streamed
past it; a larger batch sort-merges.
Only the four looked-up columns of the table are read (P1), and an equality
on the bare key is pushed into the Parquet scan (P2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glebe.functions import constants as C
from glebe.functions.owners import OWNER_FIELDS, with_owners
from glebe.functions.text import is_valid_lookup_key, status_default, to_float
from glebe.operators import registry as R
from glebe.operators.broadcast import MAX_BROADCAST_ROWS, is_small
from glebe.session import staged

# Key batches up to this size are pushed into the scan as an IN list.
PUSHED_KEYS = 1_000
# Runs of neighbouring probes that files are compared with, ranges pushed into a scan, and files named to it, at most.
RANGE_BUCKETS = 256
MAX_RANGES = 64
MAX_FILES = 5_000
# A table of so few files is streamed: one or so for each state.
FEW_FILES = 30
LOOKUP_COLUMNS = [C.KEY, "pct_obtencao", "denominacao", "proprietario"]


def point_lookup(registry: DataFrame, code: str, uf: str | None = None) -> DataFrame:
    """``SELECT codigo_incra, pct_obtencao, denominacao, proprietario … WHERE code = ? LIMIT 1``.

    With ``uf`` the state directory is pruned before any file is opened (partition filter)."""
    rows = registry.where(F.col("uf") == F.lit(uf)) if uf is not None else registry
    return rows.select(*LOOKUP_COLUMNS).where(F.col(C.KEY) == F.lit(code)).limit(1)


def lookup_by(index: DataFrame, column: str, value: str) -> DataFrame:
    """L1: the records whose ``column`` equals ``value``, from a copy of the table sorted by that column."""
    return index.select(*LOOKUP_COLUMNS, "municipio").where(F.col(column) == F.lit(value))


def shape_record(rows: DataFrame) -> DataFrame:
    """``codigo_incra, area_ha, situacao, proprietarios`` from looked-up rows (extra columns kept)."""
    out = with_owners(rows, "proprietario", "pct_obtencao", "proprietarios")
    return out.withColumn("area_ha", to_float("pct_obtencao")).withColumn("situacao", status_default("denominacao"))


def validate_keys(keys: DataFrame, key_col: str = "requested") -> DataFrame:
    """P5: add ``valid`` — the path-parameter rule on each requested key."""
    return keys.withColumn("valid", is_valid_lookup_key(key_col))


def batch_lookup(registry: DataFrame, keys: DataFrame, key_col: str = "requested") -> DataFrame:
    """Q6 + R4 for a batch: one row per requested key with ``outcome`` and the record fields.

    Invalid keys never reach the join (their probe is NULL), mirroring the 422 that is
    raised before any query runs. Plan: the distinct valid probes are size-checked and
    broadcast into an *inner* join, so the table is streamed once and never shuffled, past a pushed-down
    ``IN`` list of at most :data:`PUSHED_KEYS` keys or the range of the keys (the table is sorted by code);
    the matches (at most one per probe — codes are unique in the registry) then
    left-join back to the requested keys — a join of two key-batch-sized inputs, left to
    the planner (the matches carry free text, so they are not force-broadcast). Beyond
    the size bound both joins sort-merge, with AQE skew handling.
    """
    k, probes = _probes(keys, key_col)
    seen = probes.agg(F.count(F.lit(1)).alias("n"), F.min("__probe").alias("low"), F.max("__probe").alias("high")).first()
    table = registry.select(*LOOKUP_COLUMNS)
    if seen["n"] <= PUSHED_KEYS:  # reaches the scan: statistics and bloom filters skip row groups
        table = table.where(F.col(C.KEY).isin([r["__probe"] for r in probes.collect()]))
    else:
        table = table.where(F.col(C.KEY).between(seen["low"], seen["high"]))
    return _records(k, table, probes, seen["n"], key_col)


def _probes(keys: DataFrame, key_col: str) -> tuple[DataFrame, DataFrame]:
    """The keys with ``valid`` and ``__probe``, and the different valid probes, staged."""
    k = validate_keys(keys, key_col).withColumn("__probe", F.when(F.col("valid"), F.col(key_col)))
    return k, staged(k.select("__probe").where(F.col("__probe").isNotNull()).distinct(), "probes")


def _records(k: DataFrame, table: DataFrame, probes: DataFrame, n: int, key_col: str) -> DataFrame:
    """The requested keys with their outcome and record, from the rows of the table that may match."""
    table = table.withColumnRenamed(C.KEY, "__code")
    found = table.join(F.broadcast(probes) if n <= MAX_BROADCAST_ROWS else probes, F.col("__code") == F.col("__probe")).drop("__probe")
    joined = k.join(found, F.col("__probe") == F.col("__code"), "left")
    outcome = (
        F.when(~F.col("valid"), F.lit("invalid"))
        .when(F.col("__code").isNotNull(), F.lit("found"))
        .otherwise(F.lit("not_found"))
    )
    shaped = shape_record(joined.withColumn("outcome", outcome))
    found = F.col("outcome") == "found"
    return shaped.select(
        F.col(key_col),
        "outcome",
        F.when(found, F.col("__code")).alias(C.KEY),
        F.when(found, F.col("area_ha")).alias("area_ha"),
        F.when(found, F.col("situacao")).alias("situacao"),
        F.when(found, F.col("proprietarios")).alias("proprietarios"),
    )


def files_with(files: DataFrame, probes: DataFrame) -> DataFrame:
    """(file, low, high): the files whose range of codes holds a probe, with the least and greatest probe in it.

    The probes are cut into :data:`RANGE_BUCKETS` runs of neighbours; a file meets the runs that its range touches
    (from the runs' ends, so many literals), and there, by the run's number, the probes themselves."""
    placed = probes.repartitionByRange(RANGE_BUCKETS, "__probe").withColumn("__bucket", F.spark_partition_id())
    placed = staged(placed, "probe-ranges")
    ends = placed.groupBy("__bucket").agg(F.min("__probe").alias("low"), F.max("__probe").alias("high")).collect()  # RANGE_BUCKETS rows
    if not ends:
        return files.select("file", "low", "high").limit(0)
    runs = F.array(*[F.struct(F.lit(r["__bucket"]).alias("bucket"), F.lit(r["low"]).alias("low"), F.lit(r["high"]).alias("high")) for r in ends])
    touched = F.filter(runs, lambda r: (r["low"] <= F.col("high")) & (r["high"] >= F.col("low")))
    meets = files.select("file", F.col("low").alias("__low"), F.col("high").alias("__high"), F.explode_outer(F.transform(touched, lambda r: r["bucket"])).alias("__bucket"))
    held = meets.join(placed, "__bucket").where(F.col("__probe").between(F.col("__low"), F.col("__high")))
    return held.groupBy("file").agg(F.min("__probe").alias("low"), F.max("__probe").alias("high"))


def merged_ranges(ranges: list[tuple[str, str]], most: int = MAX_RANGES) -> list[tuple[str, str]]:
    """Disjoint ranges, ``most`` at most, that cover the given ones."""
    out: list[tuple[str, str]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    step = -(-len(out) // most) or 1
    return [(out[i][0], out[min(i + step, len(out)) - 1][1]) for i in range(0, len(out), step)]


def pruned_lookup(spark: SparkSession, table: str, keys: DataFrame, key_col: str = "requested", pushed_keys: int = PUSHED_KEYS) -> DataFrame:
    """:func:`batch_lookup` on a published table that opens only the files that can hold a requested code.

    Above ``pushed_keys`` keys, the statistics that every run leaves of its files say which files hold a probe; these
    are read by name, and their probes' ranges, merged into :data:`MAX_RANGES` disjoint ones, are pushed into the scan.
    Where more than :data:`MAX_FILES` files hold a probe, the batch covers the table and all of it is streamed."""
    registry = R.read_registry(spark, table)
    stats = R.file_stats(spark, table)
    k, probes = _probes(keys, key_col)
    n = probes.count()
    if registry is None:
        registry = spark.createDataFrame([], R.REGISTRY_SCHEMA)
    if n <= pushed_keys or stats is None or is_small(stats, FEW_FILES):
        return batch_lookup(registry, keys, key_col)
    files = staged(files_with(stats.where(F.col("low").isNotNull()), probes), "files-with-probes")
    if files.limit(MAX_FILES + 1).count() > MAX_FILES:
        return batch_lookup(registry, keys, key_col)
    named = files.collect()  # names of files, MAX_FILES at most
    rows = R.read_files(spark, table, [r["file"] for r in named]).select(*LOOKUP_COLUMNS)
    cover = F.lit(False)
    for low, high in merged_ranges([(r["low"], r["high"]) for r in named]):
        cover = cover | F.col(C.KEY).between(low, high)
    return _records(k, rows.where(cover), probes, n, key_col)


def flatten_record(records: DataFrame, key_col: str = "requested") -> DataFrame:
    """One flat row per requested key: record scalars plus owner count."""
    return records.select(
        key_col, "outcome", C.KEY, "area_ha", "situacao",
        F.when(F.col("outcome") == "found", F.size("proprietarios")).cast("int").alias("n_owners"),
    )


def record_json(records: DataFrame) -> DataFrame:
    """The response record as JSON text, ``null`` fields kept (``area_ha: null``)."""
    rec = F.struct(C.KEY, "area_ha", "situacao", "proprietarios")
    return records.select(C.KEY, F.to_json(rec, {"ignoreNullFields": "false"}).alias("json"))


def export_json(records: DataFrame, path: str) -> None:
    """Write one JSON response record per line (``null`` fields kept) to ``path``."""
    record_json(records).select("json").write.text(path)


def contract_violations(records: DataFrame) -> DataFrame:
    """Q5: one row of violation counts of the response contract (all zero when it holds)."""
    owners = F.coalesce(F.col("proprietarios"), F.array())

    def n_owner_bad(pred) -> F.Column:
        return F.size(F.filter(owners, lambda o: ~pred(o)))

    per_row = records.select(
        (F.coalesce(F.length(C.KEY), F.lit(0)) < 1).cast("int").alias("bad_code"),
        (F.col("area_ha").isNotNull() & (F.col("area_ha") < 0)).cast("int").alias("bad_area"),
        (F.coalesce(F.length("situacao"), F.lit(0)) < 1).cast("int").alias("bad_status"),
        n_owner_bad(lambda o: F.length(o["nome_completo"]) >= 1).alias("bad_owner_name"),
        n_owner_bad(lambda o: o["cpf"].rlike(C.CPF_MASK_CONTRACT)).alias("bad_cpf_mask"),
        n_owner_bad(lambda o: F.length(o["vinculo"]) >= 1).alias("bad_link"),
        n_owner_bad(lambda o: o["participacao_pct"].between(C.PCT_MIN, C.PCT_MAX)).alias("bad_pct"),
    )
    return per_row.agg(*[F.sum(c).cast("long").alias(c) for c in per_row.columns], F.count(F.lit(1)).alias("records"))


__all__ = [
    "LOOKUP_COLUMNS", "OWNER_FIELDS", "batch_lookup", "contract_violations", "export_json", "flatten_record",
    "lookup_by", "point_lookup", "pruned_lookup", "record_json", "shape_record", "validate_keys",
]
