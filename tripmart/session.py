"""Session construction and the shared scratch folder.

Cluster jobs must never write to a machine-local temporary folder: every
intermediate table goes below ``spark.checkpoint.dir``, which the cluster
points at shared storage.  Only when that setting is absent (a unit test on
a laptop) do we choose a local folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings used by tests and the benchmark.  AQE stays on so joins
# whose sides turn out small at runtime become broadcast joins and skewed
# shuffle partitions are split.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Suggested settings for a large cluster (apply with spark-submit --conf or
# the session builder).  Sizes are per partition, not per cluster, so they
# hold as the data grows; the shuffle partition count is a starting point
# that AQE coalesces or splits at runtime.
CLUSTER_CONF = {
    **{k: v for k, v in DEFAULT_CONF.items() if k != "spark.sql.session.timeZone"},
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "tripmart", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TRIPMART_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, read the setting instead
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tripmart-ckpt-")      # one machine: tests
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def session_key(spark: SparkSession) -> str:
    """Identity of the running application (for per-session memos)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        return spark.conf.get("spark.app.id", "connect")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint directory for one written table."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/tripmart/{name}-{uuid.uuid4().hex[:12]}"
