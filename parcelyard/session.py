"""The session, and the shared folder for written stages."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Rows in a shuffle against the compressed files they came from, and what one reducer
# should get. Every mapper keeps an index entry for every reducer, so the number of
# reducers is held at a level that 100 TB reach with 2 GB each: sorts and aggregates of
# that size spill within an executor's share of memory, and hold at 1 PB with 20 GB. Smaller
# inputs get reducers that need not spill.
INFLATION = 4
PARTITION_BYTES = 64 * 1024 * 1024
MOST_PARTITIONS = 200_000

# What a scan task should read: it may fold that into a hash table of some ten times the size
# within its share of an executor's memory. Larger inputs keep the number of tasks in bounds.
SPLIT_BYTES = 16 * 1024 * 1024
MOST_SPLITS = 100_000

SPLIT = "spark.sql.files.maxPartitionBytes"
SPLIT_DEFAULT = 128 * 1024 * 1024

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# Setting: Spark's default and ours.
# HotSpot never compiles a method over 8000 bytes. A wide cleaning projection in one such
# method runs at half speed; outside whole-stage code it is cut into methods that compile.
# And a task that writes two outcomes keeps two files open rather than sort its rows.
# Stages are written with zstd, some 1.5 times smaller than the files broadcasts are measured by.
TUNED = {
    "spark.sql.codegen.hugeMethodLimit": ("65535", "8000"),
    "spark.sql.maxConcurrentOutputFileWriters": ("0", "4"),
    "spark.sql.sources.fileCompressionFactor": ("1.0", "1.5"),
}


def build(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs count on; a cluster's own settings stay."""
    builder = (
        SparkSession.builder.appName("parcelyard")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession, *paths: str) -> None:
    """Fit a running session to the jobs and the input; settings already made stay.

    Adaptive execution merges shuffle partitions that turn out small but cannot split
    ordinary big ones, so it needs enough to start from.
    """
    for key, (default, ours) in TUNED.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, ours)
    total = 0
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        total += files.getContentSummary(folder).getLength()
    if spark.conf.get(SPLIT) in (f"{SPLIT_DEFAULT}b", str(SPLIT_DEFAULT), "128MB"):
        split = max(SPLIT_BYTES, min(total // MOST_SPLITS, SPLIT_DEFAULT))
        spark.conf.set(SPLIT, f"{split}b")
    wanted = min(total * INFLATION // PARTITION_BYTES, MOST_PARTITIONS)
    present = spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get(
        "spark.sql.shuffle.partitions"
    )
    if wanted > int(present):
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))


def removed_at_exit(spark: SparkSession, folder: str) -> str:
    """A folder of written stages that goes when the session's JVM ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """Where stages are written: the folder the cluster names in ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    # In local[*] the executors are this process; local-cluster has processes of its own.
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="parcelyard-"))
    return context.getCheckpointDir()
