"""Broadcast only behind a size check, with the planner's own choice beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound on rows for an explicit broadcast (file lists, key batches, state lists).
MAX_BROADCAST_ROWS = 100_000


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows. Computes ``df`` (a plan below a shuffle runs that shuffle whole)."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``F.broadcast(df)`` if it passes :func:`is_small`, else ``df`` unchanged."""
    return F.broadcast(df) if is_small(df, max_rows) else df
