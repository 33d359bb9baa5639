"""The states dimension (27 rows, fixed size, safe to broadcast)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glebe.functions.constants import LABEL_SEPARATOR, STATE_LABELS

def state_labels(spark: SparkSession) -> DataFrame:
    """``(pos, label)`` in list order; ``pos`` is 0-based.

    Built as a ``VALUES`` relation so the optimizer knows its exact (tiny) size and
    every join against it can be broadcast by Catalyst's own size check.
    """
    rows = ", ".join("({}, '{}')".format(i, label.replace("'", "''")) for i, label in enumerate(STATE_LABELS))
    return spark.sql(f"SELECT CAST(pos AS INT) AS pos, label FROM VALUES {rows} AS t(pos, label)")


def states_dim(spark: SparkSession) -> DataFrame:
    """``(pos, uf, name, label)``: each label split at its first `` - ``; marked for broadcast."""
    parts = F.split(F.col("label"), LABEL_SEPARATOR, 2)
    df = state_labels(spark).select(
        "pos", parts[0].alias("uf"), parts[1].alias("name"), "label"
    )
    return F.broadcast(df)
