"""Customers over time: pauses between orders, rolling revenue, and runs of activity.

All windows go over one row for each customer and day. A customer with a third of all sales, as
guests may be, has no more of these rows than the calendar has days, and the sales of a day are
added up in every task before they meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.aggregates import total

ROLLING_DAYS = 28
#: A run of activity ends with a pause of more days than this.
PAUSE_DAYS = 90


def customer_days(
    cleaned: DataFrame, rolling_days: int = ROLLING_DAYS, pause_days: int = PAUSE_DAYS
) -> DataFrame:
    """Per customer and day with sales: revenue, days since the last such day (null for the
    first), revenue of the last ``rolling_days`` days, this one included, and the number of the
    run of activity that the day is in, from 1."""
    days = cleaned.groupBy(
        F.col("Customer ID").alias("customer_id"), F.to_date("InvoiceDate").alias("day")
    ).agg(total("Revenue").alias("revenue"))
    number = F.unix_date("day")
    in_order = Window.partitionBy("customer_id").orderBy(number)
    rolling = in_order.rangeBetween(1 - rolling_days, Window.currentRow)
    since = F.date_diff("day", F.lag("day").over(in_order))
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = F.coalesce(F.col("days_since") > pause_days, F.lit(True)).cast("bigint")
    return (
        days.withColumn("days_since", since)
        .withColumn("rolling_revenue", F.sum("revenue").over(rolling).cast("decimal(38,2)"))
        .withColumn("run", F.sum(opens).over(so_far))
        .select("customer_id", "day", "revenue", "days_since", "rolling_revenue", "run")
    )


def activity_runs(days: DataFrame) -> DataFrame:
    """Of ``customer_days``: first and last day, days with sales and revenue of each run, and
    the pause before it."""
    return (
        days.groupBy("customer_id", "run")
        .agg(
            F.min("day").alias("first_day"),
            F.min_by("days_since", "day").alias("pause_before"),
            F.max("day").alias("last_day"),
            F.count(F.lit(1)).alias("active_days"),
            F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
        )
        .select(
            "customer_id",
            "run",
            "first_day",
            "last_day",
            "active_days",
            "revenue",
            "pause_before",
        )
    )
