"""Session settings the gate relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every gate session needs: UTC for event times, AQE for runtime
# partition coalescing and skew splitting.
GATE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(master: str = "local[8]", *, warehouse: str | None = None,
                  shuffle_partitions: int = 8, app: str = "lakeward") -> SparkSession:
    """A local session for tests and benchmarks.

    The warehouse and checkpoint folders are set only when the session does
    not already name them (a cluster names shared folders itself).
    """
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in GATE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("LAKEWARD_DRIVER_MEMORY", "8g"))
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``. Only a local session may
    leave it unset and gets a fresh scratch folder; a cluster must name one,
    for a machine-local folder is not seen by other machines."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lakeward-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
