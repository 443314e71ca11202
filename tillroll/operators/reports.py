"""Reports over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.aggregates import TOP_PRODUCTS, total


def _per_order(fact: DataFrame, key: str) -> DataFrame:
    """Revenue per order and dimension key: fewer rows for the join and the distinct
    counts, and a large key is spread over its orders."""
    return fact.groupBy(key, "invoice", "customer_id").agg(
        F.sum("revenue").alias("revenue")
    )


def export_monthly(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        _per_order(fact, "date_id")
        .join(dates.select("date_id", "year", "month"), "date_id")
        .groupBy("year", "month")
        .agg(
            total("revenue").alias("monthly_revenue"),
            F.count_distinct("invoice").alias("total_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
        .withColumn("month_year", F.make_date("year", "month", F.lit(1)))
        .orderBy("year", "month")
    )


def export_top_products(
    fact: DataFrame, products: DataFrame, limit: int = TOP_PRODUCTS
) -> DataFrame:
    """A product has one description here, so sums per code can meet it afterwards."""
    sums = fact.groupBy("stock_code").agg(
        total("revenue").alias("total_revenue"),
        F.sum("quantity").alias("total_quantity"),
        F.count_distinct("invoice").alias("total_orders"),
    )
    return (
        sums.join(products, "stock_code")
        .select(
            "stock_code", "description", "total_revenue", "total_quantity", "total_orders"
        )
        .orderBy(F.desc("total_revenue"), "stock_code")
        .limit(limit)
    )


def export_by_country(fact: DataFrame, regions: DataFrame) -> DataFrame:
    return (
        _per_order(fact, "region_id")
        .join(regions, "region_id")
        .groupBy("country", "region_group")
        .agg(
            total("revenue").alias("total_revenue"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.count_distinct("invoice").alias("total_orders"),
        )
        .orderBy(F.desc("total_revenue"), "country")
    )
