"""Spark session for our own runs. Operators work with any session they are given."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

PARTITION_BYTES = 128 * 1024 * 1024
#: The driver keeps a few bits for every pair of a map and a reduce task. With these bounds
#: they are 2 * 10^9 at most, some hundred MB; beyond, tasks get larger and spill instead.
MOST_PARTITIONS = 40_000
MOST_SPLITS = 50_000


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Enough partitions that one holds about 128 MB and every core gets two, up to a bound.

    Adaptive execution merges partitions that turn out small but never adds any, so the
    number has to be large enough for the input from the start. From 5 TB on the partitions
    grow with the input: 2.5 GB at 100 TB.
    """
    return max(2 * cores, min(math.ceil(input_bytes / PARTITION_BYTES), MOST_PARTITIONS))


def split_bytes(input_bytes: int) -> int:
    """Bytes that a scan task reads: 128 MB, and more where that were too many tasks."""
    return max(PARTITION_BYTES, math.ceil(input_bytes / MOST_SPLITS))


def create_session(
    app_name: str = "tillroll",
    master: str | None = None,
    input_bytes: int = 0,
    driver_memory: str | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    if input_bytes:
        cores = spark.sparkContext.defaultParallelism
        partitions = shuffle_partitions(input_bytes, cores)
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes(input_bytes)))
    return spark
