"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# No shuffle width and no broadcast threshold here: AQE sizes the shuffles from
# measured output and broadcasts only sides whose measured size is under Spark's limit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where that costs one more shuffle further up the plan
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Parquet is several times smaller on disk than in memory: without this, a table just
    # under the broadcast limit on disk would be broadcast at many times that size
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
    # a load is many jobs; without this, the shuffle files of each stay until the driver collects garbage
    SHUFFLE_CLEANUP: "true",
}


def get_session(app: str, **extra: str) -> SparkSession:
    """Create or reuse a session with UTC time and adaptive execution."""
    builder = SparkSession.builder.appName(app)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else created."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors can reach.

    Only a local master without that setting falls back to a folder of its own.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
        base = tempfile.mkdtemp(prefix="lapidar-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
