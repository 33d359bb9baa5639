"""Running totals inside groups of any size, without a window over a whole group.

Every group is cut into buckets along its order; the sums of the buckets are
pre-aggregated map-side and accumulated (one narrow row per bucket), and only
the rows of one bucket meet in a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Rows of a bucket at least; beyond its square, a group of n rows gets about sqrt(n) buckets of sqrt(n) rows.
BUCKET_ROWS = 2_000


def bucket_count(rows: Column) -> Column:
    """Buckets for a group of ``rows`` rows: both the rows of a bucket and the buckets of a group stay near sqrt(rows)."""
    return F.greatest(F.ceil(rows / F.greatest(F.lit(float(BUCKET_ROWS)), F.sqrt(rows))), F.lit(1)).cast("long")


def with_running_total(df: DataFrame, group: list[str], bucket: str, order: list[Column], value: str, into: str,
                       sums_of: DataFrame | None = None) -> DataFrame:
    """Add ``into``: the sum of ``value`` over the rows of the group that come before the row.

    ``sums_of`` gives the same rows in a cheaper form (narrow) for the sums of the buckets.
    ``bucket`` must be non-null and non-decreasing along ``order`` inside a group, so that the
    order is (bucket, order). Group columns must be non-null. Rows that tie on all of ``order``
    get distinct offsets in any order.
    """
    sums = (df if sums_of is None else sums_of).groupBy(*group, bucket).agg(F.sum(value).alias("_bucket_sum"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*group, bucket, F.coalesce(F.sum("_bucket_sum").over(before), F.lit(0)).cast("long").alias("_bucket_start"))
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(starts, [*group, bucket])
    start = F.col("_bucket_start") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return joined.withColumn(into, start.cast("long")).drop("_bucket_start")
