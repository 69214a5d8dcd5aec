"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Results depend on these two.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# Plans depend on these: runtime re-planning, splitting of hot join keys even where
# the split costs one more exchange downstream, pushing a list of batch ids to the
# Parquet reader value by value instead of as one range, taking compressed files for what their rows
# need in memory: a file of a few MB may hold millions of rows, which the driver would collect to broadcast them, and
# letting a broadcast wait for its turn where several models are written at once.
PHYSICAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    "spark.sql.sources.fileCompressionFactor": "20",
    "spark.sql.broadcastTimeout": "3600",
}


def configure(spark: SparkSession) -> SparkSession:
    """Applies the runtime settings to a session somebody else created."""
    for key, value in {**SEMANTIC_CONF, **PHYSICAL_CONF}.items():
        spark.conf.set(key, value)
    return spark


def build(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTIC_CONF, **PHYSICAL_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions_for(shuffled_bytes: int, target_bytes: int = 128 << 20) -> int:
    """Initial partition count so that one shuffle partition is about `target_bytes`.

    Adaptive execution merges small partitions but never splits an aggregate's,
    so the starting count has to come from the data: 100 TB needs about 800,000
    at 128 MB, not the default 200.
    """
    return max(8, -(-shuffled_bytes // target_bytes))


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished jobs. It does so when the driver collects their garbage, which a
    driver that only plans does too seldom to bound the disk of a long run."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Falls back to the local temporary folder only on a local master; a cluster
    without `spark.checkpoint.dir` is an error, since executors on other
    machines could not read what is written there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="streamtally-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
