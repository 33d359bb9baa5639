"""Operator inputs derived from the driver tables (all grow with the scale factor).

Lookup key batches, portal option lists, selection strings, acquisition
attempts and landing directories are all built by Spark from ``orders``,
``customer``, ``supplier``, ``nation``, ``region`` and ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glebe.functions import constants as C
from glebe.operators import load as L
from glebe.operators import registry as R
from glebe.plans import base as B
from glebe.sources import fs, landing
from glebe.sources.states import states_dim
from glebe.session import scratch_path

# Columns order used for files of the regions below (header binding by name).
REVERSED_REGION = "EUROPE"
NO_MATRICULA_REGION = "MIDDLE EAST"
# State codes with no nation: one lands as a header-only file, one as a zero-byte file.
HEADER_ONLY_FILE = "SP_land.csv"
ZERO_BYTE_FILE = "TO_land.csv"
SUCCESS_EVENT = "purchase"
DUPLICATE_EVERY = 97
DUPLICATE_STATE = "SP"
# Wanted options of the candidate match: the exact value of these segments, a value nobody has for the others.
CANDIDATE_SEGMENT = "BUILDING"
MAX_ROUNDS = 3
SECOND_CUTOFF = "1998-01-01"
# Tasks that write the table of small files.
SMALL_TASKS = 100
# Splits that files with line breaks in their cells are cut into, in bytes.
SMALL_SPLIT = 8_192


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry after loading ``base`` into an empty table: published once per session and input folder by the
    load job, then read as a table (sorted layout, pushed filters)."""
    return B.memo(spark, ("registry", sf_dir), lambda: _publish(spark, B.staging_from_base(B.base(spark, sf_dir)))).select(*C.TABLE_COLUMNS)


def _publish(spark: SparkSession, staging: DataFrame) -> DataFrame:
    return R.read_registry(spark, new_table(spark, staging))


def new_table(spark: SparkSession, *waves: DataFrame, rows_per_task: int | None = None) -> str:
    """A fresh registry table with one run for each wave of staged rows; returns its folder."""
    table = scratch_path(spark, "registry")
    for i, staging in enumerate(waves):
        R.run_load(spark, staging, table, run_id=f"wave{i}", max_files=B.MAX_FILES, rows_per_task=rows_per_task)
    return table


def prior_table(spark: SparkSession, sf_dir: str) -> str:
    """The registry as it stood before the current load, published once per session and input folder."""
    return B.memo(spark, ("prior", sf_dir), lambda: new_table(spark, B.staging_from_base(B.prior_wave(B.base(spark, sf_dir)))))


def three_waves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Staged rows of ``base`` landed before WAVE_CUTOFF, in the two years after it, and later."""
    b = B.base(spark, sf_dir)
    first, second = (F.lit(d).cast("date") for d in (B.WAVE_CUTOFF, SECOND_CUTOFF))
    day = F.col("landed_on")
    return [B.staging_from_base(w) for w in (b.where(day < first), b.where((day >= first) & (day < second)), b.where(day >= second))]


def small_file_table(spark: SparkSession, sf_dir: str) -> str:
    """The registry in many small files, so that what a lookup opens can be counted at any scale."""
    def build():
        staging = B.staging_from_base(B.base(spark, sf_dir))
        codes = staging.select(C.KEY).distinct().count()
        return new_table(spark, staging, rows_per_task=max(3, codes // SMALL_TASKS))

    return B.memo(spark, ("small-files", sf_dir), build)


def clustered_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested codes that lie together: those of every customer up to an eighth of the largest number."""
    c = B.read_table(spark, sf_dir, "customer")
    upto = c.agg(F.floor(F.max("c_custkey") / 8).alias("upto"))
    near = c.join(F.broadcast(upto), F.col("c_custkey") <= F.col("upto"))  # one row
    return near.select(F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("requested"))


def land_broken_lines(spark: SparkSession, sf_dir: str) -> str:
    """``base`` landed with quotes, separators and line breaks inside the cells of two columns of every row."""
    directory = scratch_path(spark, "landing")
    rows = B.staging_from_base(B.base(spark, sf_dir))
    rows = rows.withColumn("denominacao", F.concat(F.lit('said "'), "denominacao", F.lit('";\n\n'), F.col("pos")))
    landing.land_csv(spark, rows.withColumn("municipio", F.concat(F.lit("in\n"), "municipio")), directory)
    return directory


def table_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that breaks its key: every landed row typed, and every DUPLICATE_EVERY-th row in a second state too."""
    rows = L.typed(B.staging_from_base(B.base(spark, sf_dir)))
    again = rows.where(F.col("pos") % DUPLICATE_EVERY == 0).withColumn("uf", F.lit(DUPLICATE_STATE))
    return rows.unionByName(again).select(*C.TABLE_COLUMNS)


def lookup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested codes: every customer code (found), a supplier code per supplier (valid but
    unknown), and every customer name (malformed: contains ``#``)."""
    c = B.read_table(spark, sf_dir, "customer")
    s = B.read_table(spark, sf_dir, "supplier")
    return (
        c.select(F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("requested"))
        .unionByName(s.select(F.concat(F.lit("SUP."), F.lpad(F.col("s_suppkey").cast("string"), 8, "0")).alias("requested")))
        .unionByName(c.select(F.col("c_name").alias("requested")))
    )


def customer_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = B.read_table(spark, sf_dir, "customer")
    n = B.read_table(spark, sf_dir, "nation")
    r = B.read_table(spark, sf_dir, "region")
    st = states_dim(spark)
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).join(st, n.n_nationkey == st.pos)
    return c.join(F.broadcast(geo.select("n_nationkey", "n_name", "r_name", "uf", "name", "label")), c.c_nationkey == F.col("n_nationkey"))


def portal_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One select option per customer: placeholders for one segment, empty values for another."""
    g = customer_geo(spark, sf_dir)
    return g.select(
        F.col("c_custkey").alias("ord"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("Selecione o estado"))
        .otherwise(F.concat(F.col("uf"), F.lit(C.LABEL_SEPARATOR), F.col("n_name"))).alias("text"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("")).otherwise(F.lower(F.col("uf"))).alias("value"),
    )


def match_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options for the tiered match: value = UF on negative balances, text either
    ``uf - nation`` (lower-case code) or the accented label in capitals."""
    g = customer_geo(spark, sf_dir)
    return g.select(
        F.col("c_custkey").alias("ord"),
        F.when(F.col("c_acctbal") < 0, F.lower(F.col("uf"))).otherwise(F.col("c_mktsegment")).alias("value"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lower(F.col("uf")), F.lit(" - "), F.col("n_name")))
        .otherwise(F.upper(F.col("label"))).alias("text"),
    )


def selected_codes(spark: SparkSession, sf_dir: str, region: str = "AMERICA") -> DataFrame:
    n = B.read_table(spark, sf_dir, "nation")
    r = B.read_table(spark, sf_dir, "region").where(F.col("r_name") == region)
    st = states_dim(spark)
    return n.join(r, n.n_regionkey == r.r_regionkey).join(st, n.n_nationkey == st.pos).select(F.col("uf").alias("code"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acquisition attempts: state = ``user_id``, attempt time = ``ts``, success on purchases.

    ``size`` is the output file's: 0 below a value of 1, else a header line and the value; ``records`` may be 0."""
    e = B.read_table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("state"),
        "ts",
        (F.col("event_type") == SUCCESS_EVENT).alias("success"),
        F.floor("value").cast("long").alias("records"),
        F.when(F.col("value") < 1, F.lit(0.0)).otherwise(F.col("value") + 72).alias("size"),
    )


def output_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing ``(file_name, length)`` of the states' output files: every seventh is gone, every fifth is empty."""
    states = B.read_table(spark, sf_dir, "events").select(F.col("user_id").alias("state")).distinct()
    return states.where(F.col("state") % 7 != 0).select(
        F.concat(F.col("state").cast("string"), F.lit(".csv")).alias("file_name"),
        F.when(F.col("state") % 5 == 0, F.lit(0)).otherwise(F.lit(100)).cast("long").alias("length"),
    )


def land_base(spark: SparkSession, sf_dir: str, mixed_headers: bool = False, extra_files: bool = False) -> str:
    """Land ``base`` as one CSV per state in a fresh shared directory; returns the directory.

    ``mixed_headers``: files of one region use the reversed column order, files of
    another lack ``matricula``. ``extra_files``: add a header-only and a zero-byte file.
    """
    directory = scratch_path(spark, "landing")
    b = B.base(spark, sf_dir)
    stg = b.select("file", F.col("row_pos").alias("pos"), *C.DATA_COLUMNS, "uf", "region")
    if mixed_headers:
        plain = stg.where(~F.col("region").isin(REVERSED_REGION, NO_MATRICULA_REGION))
        landing.land_csv(spark, plain, directory)
        landing.land_csv(spark, stg.where(F.col("region") == REVERSED_REGION), directory, columns=list(reversed(C.DATA_COLUMNS)))
        landing.land_csv(spark, stg.where(F.col("region") == NO_MATRICULA_REGION), directory, columns=[c for c in C.DATA_COLUMNS if c != "matricula"])
    else:
        landing.land_csv(spark, stg, directory)
    if extra_files:
        landing.land_header_only(spark, directory, HEADER_ONLY_FILE)
        fs.write_small_text(spark, f"{directory}/{ZERO_BYTE_FILE}", "")
    return directory


# Files landed beside ``base`` for :func:`land_faulty`: name → (content, reason; None when the file is loaded).
HEADER = ";".join(C.DATA_COLUMNS)
FAULTY_FILES: dict[str, tuple[bytes, str | None]] = {
    "RR_cr.csv": ((HEADER + "\rRR.1;M;C;D;Zita;1\rRR.2;M;C;D;Zita;2\r").encode(), None),
    "TO_latin1.csv": (HEADER.encode() + "\nTO.1;M;São Tomé;D;Ícaro;1\n".encode("latin-1"), "invalid_utf8"),
    "TO_quote.csv": (HEADER.encode() + b'\nTO.2;"M;C;D;Zita;1\nTO.3;M;C;D;Zita;1\n', "unbalanced_quote"),
    "TO_long.csv": (HEADER.encode() + b'\nTO.4;M\nTO.5;"' + b"x" * 1_000_000 + b'"\n', "field_too_long"),
    "TO_break.csv": (HEADER.encode() + b'\nTO.6;M;"two\nlines";D;Zita;1\n', None),
    "_hidden.csv": (HEADER.encode() + b"\nTO.7;M;C;D;Zita;1\n", "unlisted_name"),
}


def land_faulty(spark: SparkSession, sf_dir: str) -> str:
    """``base`` landed, with :data:`FAULTY_FILES` beside it."""
    directory = land_base(spark, sf_dir)
    for name, (content, _) in FAULTY_FILES.items():
        fs.write_small_file(spark, f"{directory}/{name}", content)
    return directory


def land_waves(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame, DataFrame]:
    """Two landing waves of ``base`` (before / from the cutoff) as ``<UF>_w1.csv`` / ``<UF>_w2.csv``."""
    b = B.base(spark, sf_dir)
    w1 = B.prior_wave(b)
    w2 = b.where(F.col("landed_on") >= F.lit(B.WAVE_CUTOFF).cast("date"))

    def staged(df, tag):
        return B.staging_from_base(df).withColumn("file", F.concat(F.col("uf"), F.lit(f"_{tag}.csv")))

    return scratch_path(spark, "waves"), staged(w1, "w1"), staged(w2, "w2")
