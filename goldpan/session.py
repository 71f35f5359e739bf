"""Session settings for local runs; a cluster hands its own session to every function."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(app: str, cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the engine's settings, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), "wh"))
    )
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(shuffle_bytes: int, partition_bytes: int = 128 * 1024**2) -> dict[str, str]:
    """Settings for a job that shuffles about ``shuffle_bytes`` in its largest step.

    Enough shuffle partitions that each stays near ``partition_bytes`` and fits in a task's memory; adaptive execution
    merges them again in the smaller steps. All can be set on a running session.
    """
    return {
        **ENGINE_CONF,
        "spark.sql.shuffle.partitions": str(max(8, -(-shuffle_bytes // partition_bytes))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
    }


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the folder all executors share (``spark.checkpoint.dir``)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return "/".join([root.rstrip("/"), *parts])


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A path for stored intermediate data: below ``spark.checkpoint.dir``, or where that is unset, as in tests, below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return "/".join([root.rstrip("/"), *parts])
