"""Session helpers: a local builder for tests and bench, and shared scratch.

Library functions never change session settings. Scratch space (query
fixtures, lineage cuts) lives under the folder the cluster names in
``spark.checkpoint.dir``; a private folder is created only when that setting
is unset in a local session, which is the case in plain local tests. On a
cluster an unset folder is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # One machine: list files on the driver instead of in a listing job.
    # Clusters keep Spark's default (a distributed listing above 32 paths).
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "4096",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "period_etl") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session, set here only if unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="period_etl-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, label: str = "scratch") -> str:
    """A fresh, unique folder path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/period_etl/{label}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"
