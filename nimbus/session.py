"""Spark session settings the pipeline relies on.

All time arithmetic in the package is written on epoch seconds, so results do
not depend on the session zone; the zone is still pinned to UTC so that
``timestamp`` columns print and convert the same way on every machine.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for a cluster-sized job. AQE re-plans joins at runtime from real
# shuffle sizes: a side becomes a broadcast only when its measured size is under
# the threshold, else the sort-merge join stays; skewed partitions are split.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # size post-shuffle tasks by bytes, not by the default parallelism: fewer, fuller
    # tasks, and a partitioned write opens (tasks x dates) files, not (partitions x dates)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "nimbus", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with the pipeline's settings. ``master`` is only for local runs and tests."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(CLUSTER_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, stream checkpoints and staged tables.

    On a cluster this is ``spark.checkpoint.dir`` as set by the operator of the
    cluster. Only when it is unset (tests, a laptop) do we create a local one and
    register it, so ``DataFrame.checkpoint()`` works too.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no SparkContext in a Spark Connect client
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster") from None
    if not d and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if not d:
        # Only outside a cluster (tests, a laptop): a cluster names its shared folder.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="nimbus-"))
        d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one job run (created by the first write)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
