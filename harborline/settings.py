"""Session settings and the shared scratch folder.

Nothing here hard-codes a degree of parallelism: shuffle sizes belong to the
cluster (and to adaptive execution), the library only switches on the runtime
re-planning that its jobs rely on.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where that costs one more exchange: one key may
    # hold a large share of all rows
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_fallback_dirs: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(name: str, cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("HARBORLINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a
    machine-local path would be lost with its machine, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _fallback_dirs:
        path = tempfile.mkdtemp(prefix="harborline-")
        _fallback_dirs[context.applicationId] = path
    return _fallback_dirs[context.applicationId]


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, one per run of a job."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")
