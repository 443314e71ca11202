"""Tumbling windows in event time, with late rows.

A window is final once the watermark, the largest event time seen less ``lateness``, has passed
its end; rows that come after that are late and change nothing any more. The state is one row
for each open window and key. What is late in a run depends on the runs before it alone: rows of
one run are never late because of each other.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.moments import to_clock, to_instant
from tillroll.sources.staging import new_folder
from tillroll.streaming.runs import run_available, written

LENGTH = "1 hour"
LATENESS = "12 hours"
VALUE = "decimal(18,2)"


def window_totals(
    events: DataFrame,
    keys: Sequence[str] = ("event_type",),
    length: str = LENGTH,
    lateness: str = LATENESS,
) -> DataFrame:
    """Per window of ``ts`` and key the events and the sum of their values, of a table or a
    stream. A table has no late rows. Rows without a time belong to no window.

    Sums are decimal, so they do not depend on the order of arrival, and both are added up in
    every task before the shuffle, whatever the size of a key.
    """
    return (
        events.withColumn("_at", to_instant(F.col("ts")))
        .withWatermark("_at", lateness)
        .groupBy(F.window("_at", length).alias("_window"), *keys)
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum(F.col("value").cast(VALUE)).alias("total"),
        )
        .select(
            to_clock(F.col("_window.start")).alias("window_start"),
            to_clock(F.col("_window.end")).alias("window_end"),
            *keys,
            "events",
            "total",
        )
    )


def window_groups(
    events: DataFrame, keys: Sequence[str] = ("event_type",), length: str = LENGTH
) -> int:
    """About how many windows and keys a table of events has, which bounds the state."""
    windows = F.window(to_instant(F.col("ts")), length).alias("_window")
    return events.select(windows, *keys).agg(F.approx_count_distinct(F.struct("_window", *keys))).first()[0]


def window_runs(
    stream: DataFrame,
    runs: Iterable,
    keys: Sequence[str] = ("event_type",),
    length: str = LENGTH,
    lateness: str = LATENESS,
    partitions: int | None = None,
) -> DataFrame:
    """The final windows after all ``runs`` of the stream: each step of ``runs`` lets new rows
    arrive, then one run takes them. The state has so many ``partitions``."""
    spark = stream.sparkSession
    totals = window_totals(stream, keys, length, lateness)
    sink, checkpoint = new_folder(spark, "windows"), new_folder(spark, "windows-state")
    for _ in runs:
        run_available(totals, sink, checkpoint, partitions)
    return written(spark, totals, sink)


def with_late_rows(
    final: DataFrame,
    arrived: DataFrame,
    keys: Sequence[str] = ("event_type",),
    length: str = LENGTH,
    lateness: str = LATENESS,
) -> DataFrame:
    """Add ``late``: how many rows of each final window came too late.

    ``arrived`` is all that the stream was given, as a table. A key all of whose rows in a window
    were late has no final row; it appears here with no events and no total."""
    everything = window_totals(arrived, keys, length).select(
        *(F.col(c).alias(f"_{c}") for c in ("window_start", "window_end", *keys, "events"))
    )
    same = F.col("window_start") == F.col("_window_start")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    # The watermark counts milliseconds.
    latest = F.date_trunc("MILLISECOND", F.max(to_instant(F.col("ts"))))
    [closed] = arrived.agg(to_clock(latest - F.expr(f"INTERVAL {lateness}"))).first()
    counted = F.coalesce("events", F.lit(0))
    return (
        everything.where(F.col("_window_end") <= F.lit(closed).cast("timestamp_ntz"))
        .join(final, same, "left")
        .select(
            F.col("_window_start").alias("window_start"),
            F.col("_window_end").alias("window_end"),
            *(F.col(f"_{key}").alias(key) for key in keys),
            counted.alias("events"),
            "total",
            (F.col("_events") - counted).alias("late"),
        )
    )
