"""Spark session settings the jobs are written for."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at any scale: adaptive execution (runtime partition
# coalescing, skew-join splitting), broadcasts decided only on sizes measured at
# runtime (static, estimate-based broadcast planning off; AQE broadcasts a join
# side once its shuffle output is known to be under 32 MB, else sort-merge),
# per-day partition overwrite, UTC days.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def cluster_conf(total_cores: int) -> dict[str, str]:
    """Starting settings for a large cluster (say 1,000 executors over ~100 TB of events).

    Shuffle width about 3x the cores; AQE coalesces reduce partitions toward
    128 MB by size (not by core count) and splits skewed ones; scans split files
    into 256 MB tasks; broadcasts happen only for sides measured under 32 MB at
    runtime. Apply with ``SparkSession.builder.config(map=cluster_conf(n))``.
    """
    return {
        **JOB_CONF,
        "spark.sql.shuffle.partitions": str(max(8, 3 * total_cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    }


def configure(spark: SparkSession) -> SparkSession:
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "8", shuffle_partitions: int = 8, app: str = "botpulse",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, small shuffle width)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("BOTPULSE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**JOB_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts: ``spark.checkpoint.dir`` as the cluster
    sets it. Only a local session without one gets a fresh temporary folder; on a cluster
    that would be one machine's disk, so a missing setting is an error there."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="botpulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:  # classic sessions: make DataFrame.checkpoint() use the same folder
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # Spark Connect has no SparkContext; the conf alone is used there
        pass
    return path
