"""Sessions: a user's events with no pause longer than a gap, of a table or a stream.

One grouping by ``session_window`` serves both. In a table the events of a user are first put
together in bursts: those that fall into one stretch of the clock no longer than the gap are in
one session for certain. A burst is a row with its first and last moment, made by partial
aggregates in every task, so a user with a third of all events comes to the task that forms
sessions as one row for each stretch in which they were active, not one for each event. The
session window of a burst is as much longer than the gap as the burst lasts.

In a stream the state holds the open sessions; a run adds its events to them and merges sessions
that have come together. A session is final once the watermark has passed its end.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.moments import micros, to_clock, to_instant
from tillroll.sources.staging import new_folder
from tillroll.streaming.runs import run_available, written

GAP_SECONDS = 6 * 3600
LATENESS = "1 hour"
VALUE = "decimal(18,2)"


def _bursts(events: DataFrame, gap_seconds: int) -> DataFrame:
    stretch = F.floor(micros(F.col("ts")) / F.lit(gap_seconds * 1_000_000))
    return (
        events.where("ts IS NOT NULL")
        .groupBy("user_id", stretch.alias("_stretch"))
        .agg(
            F.min("ts").alias("_first"),
            F.max("ts").alias("_last"),
            F.count(F.lit(1)).alias("events"),
            F.sum(F.col("value").cast(VALUE)).alias("total"),
        )
    )


def _singles(events: DataFrame) -> DataFrame:
    return events.select(
        "user_id",
        F.col("ts").alias("_first"),
        F.col("ts").alias("_last"),
        F.lit(1).cast("bigint").alias("events"),
        F.col("value").cast(VALUE).alias("total"),
    )


def sessions(
    events: DataFrame, gap_seconds: int = GAP_SECONDS, lateness: str = LATENESS
) -> DataFrame:
    """user_id, session_start, session_end (the last event), events, total.

    A pause of exactly the gap does not end a session. Rows without a time are in no session;
    those without a user are one user.
    """
    parts = _singles(events) if events.isStreaming else _bursts(events, gap_seconds)
    lasts = (micros(F.col("_last")) - micros(F.col("_first"))) / F.lit(1_000_000)
    gap = F.make_interval(secs=(lasts + gap_seconds).cast("decimal(18,6)"))
    return (
        parts.withColumn("_at", to_instant(F.col("_first")))
        .withWatermark("_at", lateness)
        .groupBy(F.session_window("_at", gap).alias("_session"), "user_id")
        .agg(F.sum("events").alias("events"), F.sum("total").cast("decimal(38,2)").alias("total"))
        .select(
            "user_id",
            to_clock(F.col("_session.start")).alias("session_start"),
            F.timestamp_add(
                "SECOND", F.lit(-gap_seconds), to_clock(F.col("_session.end"))
            ).alias("session_end"),
            "events",
            "total",
        )
    )


def session_runs(
    stream: DataFrame,
    runs: Iterable,
    gap_seconds: int = GAP_SECONDS,
    lateness: str = LATENESS,
    partitions: int | None = None,
) -> DataFrame:
    """The sessions that are final after all ``runs`` of the stream. The state has so many
    ``partitions``."""
    spark = stream.sparkSession
    found = sessions(stream, gap_seconds, lateness)
    sink, checkpoint = new_folder(spark, "sessions"), new_folder(spark, "sessions-state")
    for _ in runs:
        run_available(found, sink, checkpoint, partitions)
    return written(spark, found, sink)
