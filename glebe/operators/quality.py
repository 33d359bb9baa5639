"""Post-load checks on the registry table (A1, A2, Q7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glebe.functions import constants as C


def count_by_uf(registry: DataFrame) -> DataFrame:
    """``SELECT uf, COUNT(*) AS total … GROUP BY uf ORDER BY uf`` (NULL last, as Postgres)."""
    return registry.groupBy("uf").agg(F.count(F.lit(1)).alias("total")).orderBy(F.col("uf").asc_nulls_last())


def count_distinct_codes(rows: DataFrame, key: str = C.KEY) -> DataFrame:
    """A2: exact distinct non-null key count."""
    return rows.agg(F.count_distinct(F.col(key)).alias("codigos_unicos"))


def totals_by_uf(files: DataFrame) -> DataFrame:
    """A1/A2/Q7 from the statistics that every run leaves of its files (:func:`glebe.operators.registry.file_stats`): per state the rows,
    which are as many codes (a code is in the table once), and the NULLs in critical columns. Counts of runs add up; no row is read."""
    return files.groupBy("uf").agg(
        F.sum("rows").cast("long").alias("total"), F.sum("null_codes").cast("long").alias("null_codes"), F.sum("null_pct").cast("long").alias("null_pct"),
        F.sum("no_owner").cast("long").alias("no_owner"), F.sum("no_status").cast("long").alias("no_status"),
    )


def quality_report(registry: DataFrame, key: str = C.KEY) -> DataFrame:
    """Q7: per ``uf`` row count, NULLs in critical columns, and codes seen more than once in the whole table.

    A code is duplicated when it occurs twice anywhere, also in two states; it then counts in each of its states.
    NULL codes are never duplicates of each other. The counts add up per task, so only a line per state is shuffled
    for them; the one wide exchange is by code and carries a count and the code's states (28 at most), also reduced
    per task first. The table is read twice, each time with its own columns.
    """
    empty = lambda c: F.col(c).isNull() | (F.col(c) == "")
    counts = registry.groupBy("uf").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(key).isNull()).alias("null_codes"),
        F.count_if(F.col("pct_obtencao").isNull()).alias("null_pct"),
        F.count_if(empty("proprietario")).alias("no_owner"),
        F.count_if(empty("denominacao")).alias("no_status"),
    )
    measures = counts.columns[1:]
    codes = registry.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.struct("uf")).alias("states"))
    duplicated = codes.where("n > 1").select(F.inline("states")).groupBy("uf").agg(F.count(F.lit(1)).alias("duplicated_codes"))
    both = counts.unionByName(duplicated, allowMissingColumns=True)
    return both.groupBy("uf").agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m) for m in [*measures, "duplicated_codes"]])
