"""Streams that are run from time to time, each run taking what has arrived since."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

SHUFFLE = "spark.sql.shuffle.partitions"
#: Rows that a partition of the state is given to hold or to take in a run.
STATE_ROWS = 100_000


def state_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions for a state that holds or takes so many ``rows`` in a run: one for each core
    at least, and the session's number at most.

    Every run stores every partition of the state, empty ones too, in each of its batches. A
    session's number that suits the input would make that most of the work of a small state."""
    most = int(spark.conf.get(SHUFFLE))
    cores = spark.sparkContext.defaultParallelism
    return min(most, max(cores, math.ceil(rows / STATE_ROWS)))


def run_available(
    rows: DataFrame, sink: str, checkpoint: str, partitions: int | None = None
) -> None:
    """Process all that has arrived and stop. State, watermark and what is done are in
    ``checkpoint``, so the next run, or one after a failure, goes on from there; ``sink`` gets
    every row once. ``partitions`` of the state are those of the first run, by default as many as
    the session shuffles to."""
    conf = rows.sparkSession.conf
    usual = conf.get(SHUFFLE)
    # A query keeps the settings that it is started with.
    conf.set(SHUFFLE, str(partitions or usual))
    try:
        query = _start(rows, sink, checkpoint)
    finally:
        conf.set(SHUFFLE, usual)
    query.awaitTermination()


def _start(rows: DataFrame, sink: str, checkpoint: str):
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def written(spark: SparkSession, rows: DataFrame, sink: str) -> DataFrame:
    """What the runs have written to ``sink`` so far, in the schema of ``rows``."""
    stored = spark.read.schema(rows.schema).parquet(sink)
    return stored.select(rows.columns)
