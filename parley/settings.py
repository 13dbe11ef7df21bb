"""Session profiles and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

MB = 1024 * 1024

# The two profiles that the throughput comparison runs against each other.
TUNED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * MB),
    "spark.sql.files.maxPartitionBytes": str(128 * MB),
    "spark.sql.shuffle.partitions": "400",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.parquet.compression.codec": "snappy",
}
BASELINE = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.adaptive.skewJoin.enabled": "false",
    "spark.sql.shuffle.partitions": "200",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.files.maxPartitionBytes": str(512 * MB),
}
# Executor scaling belongs to the cluster, so it is kept apart from the query profiles.
SCALING = {
    "spark.dynamicAllocation.enabled": "true",
    "spark.dynamicAllocation.minExecutors": "2",
    "spark.dynamicAllocation.maxExecutors": "20",
}
PROFILES = {"tuned": TUNED, "baseline": BASELINE}


def open_session(
    name: str, profile: str = "tuned", master: str | None = None, scaling: bool = False, **extra: str
) -> SparkSession:
    """Start (or join) a session with one of the named profiles; ``scaling`` lets the cluster add and remove executors."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in {**PROFILES[profile], **(SCALING if scaling else {}), **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for files that outlive one job: streams, sinks, manifests.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Only a local session may go
    without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="parley-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
