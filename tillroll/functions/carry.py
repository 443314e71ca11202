"""Values carried forward along an order, for keys of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.sources.staging import stage

PART = "_part"


def carry_forward(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name``: the last ``value`` that is not null at or before each row of its key.

    Rows are dealt out by ranges of key and order, so a key with very many rows is cut into
    several parts, and sorted and numbered there. Windows work inside the parts. What a part finds from the parts before it is
    one value at most, as only its first key can have begun earlier: there are no more such
    values than parts, and they are broadcast. Order columns should tell rows apart, or equal
    ones stay in one part. A null key is a key like any other but carries nothing between parts.
    """
    spark = rows.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        rows.withColumn("_value", value)
        .repartitionByRange(parts, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(PART, F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id())
    )
    ordered = stage(ordered, "ordered")
    within = (
        Window.partitionBy(PART, *keys)
        .orderBy("_row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    held = F.when(F.col("_value").isNotNull(), F.col("_row"))
    ends = ordered.groupBy(PART, *keys).agg(F.max(held).alias("_end"))
    earlier = (
        Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        ends.withColumn("_from", F.last("_end", ignorenulls=True).over(earlier))
        .where(F.col("_from").isNotNull())
        .drop("_end")
    )
    found = (
        ordered.select(F.col("_row").alias("_from"), F.col("_value").alias("_found"))
        .join(F.broadcast(carried), "_from")
        .drop("_from")
    )
    kept = [c for c in rows.columns if c != name]
    here = F.last("_value", ignorenulls=True).over(within)
    return (
        ordered.withColumn("_here", here)
        .join(F.broadcast(found), [PART, *keys], "left")
        .select(*kept, F.coalesce("_here", "_found").alias(name))
    )
