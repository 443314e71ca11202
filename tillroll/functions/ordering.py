"""Exact ranks, numbers and quantiles without sorting everything in one task.

A global ``row_number`` or a ``percentile`` ends in a single task. Here the rows are first
put into bands whose order agrees with the sort order. One small aggregate per band tells
how much lies in the bands before it; the sort itself runs band by band, in parallel.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.scalars import order_band
from tillroll.sources.staging import stage

BAND = "_band"
BEFORE = "_before"


def band_offsets(
    rows: DataFrame,
    weight: Column,
    group: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """One row per (group, band): its weight and the weight of the bands before it."""
    totals = rows.groupBy(*group, BAND).agg(F.sum(weight).alias("_weight"))
    order = F.desc(BAND) if descending else F.asc(BAND)
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return totals.withColumn(
        BEFORE, F.coalesce(F.sum("_weight").over(earlier), F.lit(0).cast("bigint"))
    )


def number_rows(rows: DataFrame, key: str, band: Column, name: str) -> DataFrame:
    """Add ``name``: 1, 2, 3 … in the order of the unique column ``key``.

    ``band`` must not fall as ``key`` rises, and must never be null: the join would add a
    null test to one of the two readers of ``rows`` only, which then could not share work.
    """
    banded = rows.withColumn(BAND, band)
    offsets = band_offsets(banded, F.lit(1)).select(BAND, BEFORE)
    inside = F.row_number().over(Window.partitionBy(BAND).orderBy(key))
    return (
        banded.join(offsets, BAND)
        .withColumn(name, (F.col(BEFORE) + inside).cast("bigint"))
        .drop(BAND, BEFORE)
    )


def _in_ranges(rows: DataFrame, *order: Column | str) -> DataFrame:
    """``rows`` in partitions that are ranges of ``order``, each marked with its number. The
    ranges follow a sample of the data, so they are stored before anything relies on them."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).withColumn(BAND, F.spark_partition_id())
    return stage(dealt, "ranges")


def number_by_range(rows: DataFrame, key: str, name: str) -> DataFrame:
    """As ``number_rows``, for keys of which no bands are known: partitions are ranges of them."""
    ranges = _in_ranges(rows, key)
    offsets = band_offsets(ranges, F.lit(1)).select(BAND, BEFORE)  # one row for each partition
    inside = F.row_number().over(Window.partitionBy(BAND).orderBy(key))
    return (
        ranges.withColumn(name, inside)
        .join(F.broadcast(offsets), BAND)
        .withColumn(name, (F.col(BEFORE) + F.col(name)).cast("bigint"))
        .drop(BAND, BEFORE)
    )


def rank_within(rows: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Add ``name``: the rank of ``value``, highest first, inside each ``group``.

    Ties share a rank and leave a gap, as ``rank()`` does; null comes after all values. Rows are
    dealt out by ranges of group and value, so neither a group with most of the rows nor a value
    shared by very many of them comes to a single task. Ranks are taken inside the ranges. What
    lies before a range matters to its first group alone, as every other one begins in it; that
    is one row at most for each range, and is broadcast. A value that goes on from one range into
    the next keeps the rank that it had where it began.
    """
    salt = F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns))
    ranges = _in_ranges(
        rows.withColumn("_salt", salt), F.col(group), F.desc_nulls_last(value), F.col("_salt")
    ).drop("_salt")
    counts = ranges.groupBy(BAND, group, value).agg(F.count("*").alias("_n"))
    nulls = F.coalesce(F.sum(F.when(F.col(value).isNull(), F.col("_n"))), F.lit(0))
    # Where a range begins, and where it ends and with how many rows: null ends it.
    spans = counts.groupBy(BAND, group).agg(
        F.sum("_n").alias("_rows"),
        F.max(value).alias("_first"),
        F.when(nulls == 0, F.min(value)).alias("_last"),
        F.when(nulls > 0, nulls).otherwise(F.min_by("_n", value)).alias("_ending"),
    )
    in_order = Window.partitionBy(group).orderBy(BAND)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    alike = Window.partitionBy(group, "_last").orderBy(BAND).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    goes_on = F.lag("_last").over(in_order).eqNullSafe(F.col("_first"))
    offsets = (
        spans.withColumn("_same", F.sum("_ending").over(alike))
        .withColumn(BEFORE, F.sum("_rows").over(earlier))
        .withColumn("_begun", F.when(goes_on, F.lag("_same").over(in_order)).otherwise(F.lit(0)))
        .where(F.col(BEFORE).isNotNull())
        .select(
            F.col(BAND).alias("_right_band"),
            F.col(group).alias("_right_group"),
            "_first",
            BEFORE,
            "_begun",
        )
    )
    inside = Window.partitionBy(BAND, group).orderBy(F.desc_nulls_last(value))
    same = (F.col(BAND) == F.col("_right_band")) & F.col(group).eqNullSafe(F.col("_right_group"))
    before = F.coalesce(BEFORE, F.lit(0)) - F.when(
        F.col(value).eqNullSafe(F.col("_first")), F.coalesce("_begun", F.lit(0))
    ).otherwise(0)
    return (
        ranges.withColumn(name, F.rank().over(inside))
        .join(F.broadcast(offsets), same, "left")
        .withColumn(name, (F.col(name) + before).cast("bigint"))
        .select(*rows.columns, name)
    )


def quantiles(counts: DataFrame, points: Mapping[str, float]) -> DataFrame:
    """Exact, linearly interpolated quantiles as one row.

    ``counts`` has one row per distinct ``value`` with its frequency ``n``. Only the bands
    that hold a wanted position are sorted.
    """
    banded = counts.withColumn(BAND, order_band(F.col("value")))
    offsets = band_offsets(banded, F.col("n")).withColumn(
        "_total", F.sum("_weight").over(Window.partitionBy())
    )

    def position(point: float) -> Column:
        return (F.col("_total") - 1) * F.lit(point)

    def holds(index: Column, start: Column, size: Column) -> Column:
        return (start <= index) & (index < start + size)

    wanted = F.lit(False)
    for point in points.values():
        for index in (F.floor(position(point)), F.ceil(position(point))):
            wanted = wanted | holds(index, F.col(BEFORE), F.col("_weight"))
    # At most two bands per point, so this side has a handful of rows whatever the data.
    chosen = offsets.where(wanted).select(BAND, BEFORE, "_total")

    earlier = Window.partitionBy(BAND).orderBy("value").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = banded.join(F.broadcast(chosen), BAND).withColumn(
        "_start", F.col(BEFORE) + F.coalesce(F.sum("n").over(earlier), F.lit(0))
    )

    def value_at(index: Column) -> Column:
        return F.max(F.when(holds(index, F.col("_start"), F.col("n")), F.col("value")))

    ends = [F.max("_total").alias("_total")]
    for name, point in points.items():
        ends.append(value_at(F.floor(position(point))).alias(f"{name}_low"))
        ends.append(value_at(F.ceil(position(point))).alias(f"{name}_high"))
    found = placed.agg(*ends)

    def between(name: str, point: float) -> Column:
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        share = position(point) - F.floor(position(point))
        return F.when(low == high, low).otherwise(low + (high - low) * share)

    return found.select(*(between(n, p).alias(n) for n, p in points.items()))
