"""Session settings the jobs count on."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

# Joins carry no broadcast hints: Spark compares measured sizes with its own
# threshold and falls back to a shuffled join, and the adaptive planner splits
# the partitions of hot keys, also where that costs one more shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What one task reads, of files and of shuffles: compressed columns and pairs of ids grow
    # some twentyfold in sorts and hash maps, and a task must hold these without spilling.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


# Shuffles start with one partition per this much input, read from compressed
# columns that grow about threefold in memory; the adaptive planner merges the
# small ones.
INPUT_PER_PARTITION = 48 * 1024**2


def starting_partitions(input_bytes: int) -> int:
    """Partitions that keep their size, however large the input is."""
    return math.ceil(input_bytes / INPUT_PER_PARTITION)


def configure(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Apply the settings; large inputs raise the number of shuffle partitions."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    wanted = starting_partitions(input_bytes)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return spark


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Size of the files below a folder, from the file system's own listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getContentSummary(path).getLength()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    A session without one is refused: in a folder of one machine, each executor
    would write to its own disk and later reads would miss those rows.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder through the file system that holds it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
