"""Operators on events and on the orders and shipments beside them, as queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.moments import DAY, micros
from tillroll.functions.scalars import exact_sum
from tillroll.operators import as_of, intervals, semistructured, sketches
from tillroll.sources.events import as_runs, in_event_time, read_events
from tillroll.sources.staging import stage
from tillroll.streaming import event_windows, sessions
from tillroll.streaming.runs import state_partitions

#: A tenth of the events come up to two days late.
LATE_EVERY, LATE_DIGIT, LATE_HOURS = 10, 3, 48
WINDOW_RUN_DAYS, SESSION_RUN_DAYS = 6, 12


def _period(moment: Column, days: int) -> Column:
    return F.floor(micros(moment) / F.lit(days * DAY)).cast("bigint")


def _event_windows(spark: SparkSession, folder: str) -> DataFrame:
    events = read_events(spark, folder)
    hours = F.when(
        F.col("event_id") % LATE_EVERY == LATE_DIGIT, F.col("event_id") % LATE_HOURS
    ).otherwise(0)
    arrived = F.timestamp_add("HOUR", hours.cast("int"), F.col("ts"))
    stream, runs = as_runs(events, _period(arrived, WINDOW_RUN_DAYS))
    # Tasks add up their windows first, so a run gives a partition a row for each group and task.
    partitions = state_partitions(spark, event_windows.window_groups(events))
    final = event_windows.window_runs(stream, runs, partitions=partitions)
    return event_windows.with_late_rows(final, events)


def _window_totals(spark: SparkSession, folder: str) -> DataFrame:
    return event_windows.window_totals(read_events(spark, folder))


def _sessions(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.sessions(read_events(spark, folder))


def _session_stream(spark: SparkSession, folder: str) -> DataFrame:
    events = read_events(spark, folder)
    stream, runs = as_runs(events, _period(F.col("ts"), SESSION_RUN_DAYS))
    return sessions.session_runs(stream, runs, partitions=state_partitions(spark, events.count()))


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    schema = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"
    return spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/orders.parquet")


def _last_event(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder).select(
        "o_orderkey",
        F.col("o_custkey").alias("user_id"),
        in_event_time(F.col("o_orderdate")).alias("moment"),
    )
    return as_of.as_of_join(
        orders,
        read_events(spark, folder),
        ["user_id"],
        "moment",
        "ts",
        ["event_id", "event_type", "ts"],
        tie=["event_id"],
    )


def _recent_event(spark: SparkSession, folder: str) -> DataFrame:
    """The last purchase before or at each event of its user, if within a week."""
    events = read_events(spark, folder)
    purchases = events.where("event_type = 'purchase'").select(
        "user_id",
        F.col("ts").alias("purchased"),
        F.col("event_id").alias("purchase_id"),
        F.col("value").alias("purchase_value"),
    )
    return as_of.as_of_join(
        events.select("event_id", "user_id", "ts"),
        purchases,
        ["user_id"],
        "ts",
        "purchased",
        ["purchase_id", "purchased", "purchase_value"],
        tie=["purchase_id"],
        inclusive=True,
        within_seconds=7 * 86_400,
    )


def _shipments(spark: SparkSession, folder: str) -> DataFrame:
    """Line items under way from the order to the shipping date."""
    schema = "l_orderkey bigint, l_linenumber int, l_shipdate timestamp_ntz"
    lines = spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/lineitem.parquet")
    joined = lines.join(_orders(spark, folder), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        in_event_time(F.col("o_orderdate")).alias("start"),
        in_event_time(F.col("l_shipdate")).alias("end"),
    )


def _campaign_shipments(spark: SparkSession, folder: str) -> DataFrame:
    """How many shipments were under way in each campaign, and how many seconds of it. A
    campaign lasts from the first to the last event of a type on a day."""
    campaigns = (
        read_events(spark, folder)
        .groupBy("event_type", F.to_date("ts").alias("day"))
        .agg(F.min("ts").alias("start"), F.max("ts").alias("end"))
    )
    pairs = intervals.overlapping_pairs(
        _shipments(spark, folder), campaigns, names=("shipment_", "campaign_")
    )
    lasts = F.col("overlap_micros")
    return pairs.groupBy(
        F.col("campaign_event_type").alias("event_type"), F.col("campaign_day").alias("day")
    ).agg(
        F.count(F.lit(1)).alias("shipments"),
        exact_sum(lasts).alias("micros"),
    )


def _same_user_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of sessions of a user's neighbours: sessions of users with one last digit, with a
    pause of two hours at most, that overlap in time; the smaller user first."""
    found = stage(  # both sides read it
        sessions.sessions(read_events(spark, folder), 2 * 3600).select(
            "user_id",
            (F.col("user_id") % 10).alias("digit"),
            "session_start",
            "session_end",
        ),
        "sessions",
    )
    pairs = intervals.overlapping_pairs(
        found, found, "session_start", "session_end", ["digit"], ("a_", "b_")
    )
    return pairs.where("a_user_id < b_user_id").select(
        "a_user_id", "b_user_id", "overlap_start", "overlap_end"
    )


def _sketch_weeks(spark: SparkSession, folder: str) -> DataFrame:
    """Weeks merged from daily sketches, and whether what they say is near the exact figures."""
    events = read_events(spark, folder)
    daily = stage(sketches.daily_sketches(events), "daily-sketches")
    monday = F.date_trunc("WEEK", F.col("day")).cast("date")
    weeks = daily.select(monday.alias("first_day")).distinct()
    weeks = weeks.withColumn("last_day", F.date_add("first_day", 6))
    merged = stage(sketches.merge_ranges(daily, weeks), "weeks")
    measured = sketches.measured_errors(merged, events)
    ranks = F.greatest(*(f"{name}_rank_error" for name in sketches.QUANTILES))
    return measured.select(
        "first_day",
        "last_day",
        "events",
        "exact_items",
        (F.col("items_error") <= 0.05).alias("items_close"),
        (ranks <= 0.02).alias("quantiles_close"),
    )


def _event_props(spark: SparkSession, folder: str) -> DataFrame:
    """The properties of events as columns, with how many fields are left over."""
    events = read_events(spark, folder)
    fields = semistructured.choose_fields(events, "props")
    return semistructured.shred(events, "props", fields).withColumn(
        "rest", F.coalesce(F.size("rest"), F.lit(0))
    )


QUERIES = {
    "event_windows": _window_totals,
    "event_windows_late": _event_windows,
    "user_sessions": _sessions,
    "user_sessions_stream": _session_stream,
    "asof_last_event": _last_event,
    "asof_recent_purchase": _recent_event,
    "interval_campaigns": _campaign_shipments,
    "interval_sessions": _same_user_overlaps,
    "sketch_weeks": _sketch_weeks,
    "event_props": _event_props,
}
