"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Settings the jobs are written for. Skewed joins rely on AQE splitting the
# oversized side; month and year boundaries rely on UTC.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Tables written on the way have a known size; up to here they are broadcast.
    # Compressed Parquet takes about three times its size in memory.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # Recording the call site of every Column costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app: str = "activity_lake", cpus: str | int = 8, **extra: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    extra.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix="activity_lake-"))
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a master within this process may fall back to a temporary folder of
    this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir(spark.sparkContext.applicationId)


@lru_cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix="activity_lake-")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a stage table; never handed out twice."""
    return f"{shared_dir(spark)}/activity_lake/{name}-{uuid.uuid4().hex}"
