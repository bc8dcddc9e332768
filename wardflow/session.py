"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the package relies on. Joins carry no broadcast hints: Spark broadcasts a side only when its
# size is under the threshold (again checked at run time), shuffles it otherwise, and splits skewed partitions.
# Sizes are estimated from files, where a row takes an eighth or less of its bytes in memory (and a row of a broadcast
# table several times those), so files count eight times. The threshold leaves room for several broadcasts at once in a
# driver of 750 MB.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when a later aggregate then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(16 * 1024 * 1024),
    "spark.sql.sources.fileCompressionFactor": "8.0",
    # Aggregates that build a set per key stay hash based for many keys per task before they fall back to sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the package settings to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "wardflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Where none is set, a local session gets one of its own; a cluster is refused,
    since each of its machines would write to its own disk."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="wardflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_workspace(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created until a job writes there."""
    return f"{shared_dir(spark)}/wardflow/{label}-{uuid.uuid4().hex[:12]}"
