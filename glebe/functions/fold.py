"""Exact NFKD accent folding for file names.

Spark SQL has no Unicode normalisation function; compatibility characters (``½``, ``ﬁ``) need NFKD. So the
different labels of a table (states, file names: few beside the rows) are folded in one Arrow-batched UDF, and
joined back; the rows themselves never pass Python.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from glebe.operators.broadcast import bounded_broadcast
from glebe.session import staged

_UNSAFE = re.compile(r"[^A-Za-z0-9_-]")


def _safe_one(s):
    if s is None:
        return None
    folded = "".join(ch for ch in unicodedata.normalize("NFKD", s) if not unicodedata.combining(ch))
    return _UNSAFE.sub("_", folded).strip("_")


@F.pandas_udf(StringType())
def safe_filename(s: pd.Series) -> pd.Series:
    return s.map(_safe_one)


def with_safe_filename(df: DataFrame, label: str, into: str) -> DataFrame:
    """Add ``into``, the safe file name of column ``label``. Distinct labels are folded (pre-aggregated, so a hot
    label is one row per task) and joined back null-safely; a small list is broadcast after a check of its size."""
    folded = staged(df.select(F.col(label).alias("__label")).distinct().withColumn("__safe", safe_filename("__label")), "labels")
    joined = df.join(bounded_broadcast(folded), F.col(label).eqNullSafe(F.col("__label")), "left")
    return joined.withColumn(into, F.col("__safe")).drop("__label", "__safe")
