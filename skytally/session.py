"""Session settings the library relies on, and where it may put scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that can be changed on a running session. Sizes are Spark's own units.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # partition labels are strings ('07' must not come back as 7)
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "skytally", master: str | None = None, **extra) -> SparkSession:
    """Create (or fetch) a session; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path for an intermediate table.

    The cluster names its shared folder in ``spark.checkpoint.dir``; only when that is
    unset (a single-machine test) does a local temporary folder serve instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="skytally-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
