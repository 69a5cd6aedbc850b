"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings every riskframe job relies on: UTC timestamps (parity with DuckDB), AQE for
# runtime coalescing/skew handling, Arrow for the few pandas hand-offs, no UI server.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "riskframe") -> SparkSession:
    """Local session for tests and the bench; clusters bring their own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("RISKFRAME_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    The setting is only read, never written: Spark takes it when the context starts, so a
    cluster (or the test session) names the folder on the builder. A local-mode session
    without it gets a scratch folder of its own; on a cluster a missing setting is an error,
    because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running riskframe jobs")
        configured = tempfile.mkdtemp(prefix="riskframe-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Used before iterative work (fold fits, repeated scans of an encoded frame)
    so a lost executor recomputes from the checkpoint, not from the raw scan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def persist(df: DataFrame) -> DataFrame:
    """Cache that spills instead of failing; lost blocks are recomputed from lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
