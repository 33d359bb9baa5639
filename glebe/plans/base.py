"""Registry-shaped relations derived from the driver tables.

The driver tables carry no registry data, so every query runs on ``base``:
one landing row per order, keyed by the customer code, in the state file of
the customer's nation. It has duplicate codes (one per order), empty statuses,
three owner separators, repeated owners, CPF-shaped numbers, decimal commas,
negative and > 100 percentages.

``landed_on`` (the order date) orders rows into load waves: rows landed before
:data:`WAVE_CUTOFF` form the registry as it stood before the current load.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glebe.functions.constants import STATE_LABELS
from glebe.sources.states import states_dim

WAVE_CUTOFF = "1996-01-01"
# Fault injection for the quarantine fixture, by data rule (region and order priority).
LONG_MATRICULA_REGION = "AFRICA"
LONG_MATRICULA_PRIORITY = "1-URGENT"
LOWERCASE_UF_REGION = "EUROPE"
LONG_UF_REGION = "MIDDLE EAST"
OVERFLOW_REGION = "ASIA"
OVERFLOW_PCT = "123456789,5"
# Landing files of ``base`` are one per state code (two spellings with the fault rule):
# a bound known by construction, used to broadcast per-file lists without counting.
MAX_FILES = 2 * len(STATE_LABELS)


# DataFrame handles (plans, not data) per session: the driver tables are read-only, so one
# schema inference per table and one analysed ``base`` plan serve every query of a session.
_HANDLES: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def memo(spark: SparkSession, key: tuple, build):
    per_session = _HANDLES.setdefault(spark, {})
    if key not in per_session:
        per_session[key] = build()
    return per_session[key]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return memo(spark, ("table", sf_dir, name), lambda: spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _cpf_like(custkey) -> F.Column:
    d = F.lpad((custkey * 7919).cast("string"), 11, "1")
    return F.concat(
        F.substring(d, 1, 3), F.lit("."), F.substring(d, 4, 3), F.lit("."), F.substring(d, 7, 3), F.lit("-"), F.substring(d, 10, 2)
    )


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``codigo_incra, matricula, row_pos, municipio, denominacao, proprietario, pct_obtencao,
    uf_key, landed_on, region, priority, uf, file`` — one row per order."""
    return memo(spark, ("base", sf_dir), lambda: _build_base(spark, sf_dir))


def _build_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation (25 rows) and region (5 rows) are fixed-size dimensions of the schema.
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    sep = (
        F.when(F.col("c_custkey") % 3 == 0, F.lit(" | "))
        .when(F.col("c_custkey") % 3 == 1, F.lit(" e "))
        .otherwise(F.lit(";"))
    )
    rows = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.lpad(F.col("o_custkey").cast("string"), 11, "0").alias("codigo_incra"),
            F.concat(F.lit("MTR"), F.col("o_orderkey").cast("string")).alias("matricula"),
            F.col("o_orderkey").alias("row_pos"),
            F.col("n_name").alias("municipio"),
            F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus")).alias("denominacao"),
            F.concat(
                F.col("c_name"), F.lit(" "), _cpf_like(F.col("c_custkey")), sep, F.col("n_name"), F.lit(" e "), F.col("n_name")
            ).alias("proprietario"),
            F.replace(F.col("c_acctbal").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")).alias("pct_obtencao"),
            F.col("c_nationkey").alias("uf_key"),
            F.col("o_orderdate").cast("date").alias("landed_on"),
            F.col("r_name").alias("region"),
            F.col("o_orderpriority").alias("priority"),
        )
    )
    st = states_dim(spark).select(F.col("pos").alias("uf_key"), "uf")
    return rows.join(st, "uf_key").withColumn("file", F.concat(F.col("uf"), F.lit("_land.csv")))


def base_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``base`` with rule-injected faults: over-long ``matricula`` on urgent orders of one region,
    lower-case (unknown) state prefix in the file names of another region, a three-letter one in a third, and a
    percentage beyond the column's precision on urgent orders of a fourth."""
    return memo(spark, ("faulty", sf_dir), lambda: _build_faulty(spark, sf_dir))


def _build_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base(spark, sf_dir)
    long_m = (F.col("region") == LONG_MATRICULA_REGION) & (F.col("priority") == LONG_MATRICULA_PRIORITY)
    lower_uf = F.col("region") == LOWERCASE_UF_REGION
    long_uf = F.col("region") == LONG_UF_REGION
    overflow = (F.col("region") == OVERFLOW_REGION) & (F.col("priority") == LONG_MATRICULA_PRIORITY)
    return (
        b.withColumn(
            "matricula",
            F.when(long_m, F.concat(F.lit("MTR"), F.lpad(F.col("row_pos").cast("string"), 12, "0"), F.lit("-"), F.col("priority")))
            .otherwise(F.col("matricula")),
        )
        .withColumn("pct_obtencao", F.when(overflow, F.lit(OVERFLOW_PCT)).otherwise(F.col("pct_obtencao")))
        .withColumn("uf", F.when(lower_uf, F.lower(F.col("uf"))).when(long_uf, F.concat("uf", F.lit("X"))).otherwise(F.col("uf")))
        .withColumn("file", F.concat(F.col("uf"), F.lit("_land.csv")))
    )


def staging_from_base(b: DataFrame) -> DataFrame:
    """The landing contract the load operators take: ``file, pos`` + the six text columns + ``uf``."""
    return b.select(
        "file",
        F.col("row_pos").alias("pos"),
        "codigo_incra", "matricula", "municipio", "denominacao", "proprietario", "pct_obtencao", "uf",
    )


def prior_wave(b: DataFrame) -> DataFrame:
    return b.where(F.col("landed_on") < F.lit(WAVE_CUTOFF).cast("date"))
