"""Sales at several levels of detail at once, with exact distinct counts at each."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalars import region_group
from tillroll.operators.aggregates import per_order, total

LEVEL = "level"


def rollup_sets(keys: Sequence[str]) -> list[tuple[str, ...]]:
    """All keys, then without the last, and so on to the grand total."""
    return [tuple(keys[:n]) for n in range(len(keys), -1, -1)]


def cube_sets(keys: Sequence[str]) -> list[tuple[str, ...]]:
    """Every selection of keys."""
    return [c for n in range(len(keys), -1, -1) for c in combinations(keys, n)]


def sales_by_sets(
    lines: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]]
) -> DataFrame:
    """Revenue, orders and customers for each of the grouping ``sets``.

    ``level`` has a bit for each key, the first the highest, set where the key is summed over; it
    tells a null that was in the data from one that stands for all. The lines are shuffled once,
    to one row for each order and combination of keys. Distinct counts do not add up over levels,
    so these rows, and for the customers one row for each combination, are what is expanded.
    """
    order_rows = per_order(lines, *keys)
    grouped = [list(s) for s in sets]
    by_orders = order_rows.groupingSets(grouped, *keys).agg(
        F.grouping_id().alias(LEVEL),
        total("Revenue").alias("revenue"),
        F.count_distinct("Invoice").alias("orders"),
    )
    by_customers = (
        order_rows.groupBy(*keys, "Customer ID")
        .agg(F.lit(1).alias("_one"))
        .groupingSets(grouped, *keys)
        .agg(F.grouping_id().alias(LEVEL), F.count_distinct("Customer ID").alias("customers"))
    )
    same = F.col(LEVEL) == F.col("_level")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    renamed = by_customers.select(
        F.col(LEVEL).alias("_level"), *(F.col(k).alias(f"_{k}") for k in keys), "customers"
    )
    return by_orders.join(renamed, same).select(*keys, LEVEL, "revenue", "orders", "customers")


def with_region(cleaned: DataFrame) -> DataFrame:
    return cleaned.withColumn("Region", region_group(F.col("Country")))


def sales_rollup(cleaned: DataFrame) -> DataFrame:
    """Region, country, year, month, and each of their totals."""
    keys = ("Region", "Country", "Year", "Month")
    return sales_by_sets(with_region(cleaned), keys, rollup_sets(keys))


def sales_cube(cleaned: DataFrame) -> DataFrame:
    """Region, year and weekday in every combination."""
    keys = ("Region", "Year", "Weekday")
    return sales_by_sets(with_region(cleaned), keys, cube_sets(keys))


def sales_grouping_sets(cleaned: DataFrame) -> DataFrame:
    """By country and year, by month over all countries, and by hour."""
    keys = ("Country", "Year", "Month", "Hour")
    return sales_by_sets(cleaned, keys, [("Country", "Year"), ("Year", "Month"), ("Hour",)])
