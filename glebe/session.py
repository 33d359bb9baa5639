"""Session defaults and the shared scratch area.

Scratch data (staged files, landed fixtures, intermediate tables) lives under
the cluster's ``spark.checkpoint.dir``, a shared folder every executor can
reach. Only when a session has none (local tests) do we pick one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "glebe", shuffle_partitions: int = 8, **extra) -> SparkSession:
    """Session for tests and the bench. On a cluster, pass nothing and let spark-submit decide."""
    b = SparkSession.builder.master(master).appName(app)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**DEFAULTS, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set one only if it is unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — a remote session exposes only its conf
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="glebe-ckpt-")  # one machine: tests and the bench
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused directory under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/glebe/{purpose}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to a fresh scratch folder and read back: plans that use it twice compute it once."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
