"""Revenue aggregates over cleaned invoice lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions.ordering import rank_within

TOP_PRODUCTS = 20


def total(column: str):
    return F.sum(column).cast(schemas.MONEY_TOTAL)


def per_order(cleaned: DataFrame, *keys: str) -> DataFrame:
    """Revenue per invoice and customer inside ``keys``.

    Counting distinct invoices and customers multiplies the rows. Doing this first leaves
    one row per order instead of one per line, and spreads a large key over its invoices.
    """
    return cleaned.groupBy(*keys, "Invoice", "Customer ID").agg(
        F.sum("Revenue").alias("Revenue")
    )


def monthly(cleaned: DataFrame) -> DataFrame:
    return (
        per_order(cleaned, "Year", "Month")
        .groupBy("Year", "Month")
        .agg(
            total("Revenue").alias("MonthlyRevenue"),
            F.count_distinct("Invoice").alias("TotalOrders"),
            F.count_distinct("Customer ID").alias("UniqueCustomers"),
        )
        .orderBy("Year", "Month")
    )


def top_products(cleaned: DataFrame, limit: int = TOP_PRODUCTS) -> DataFrame:
    return (
        cleaned.groupBy("StockCode", "Description")
        .agg(
            total("Revenue").alias("TotalRevenue"),
            F.sum("Quantity").alias("TotalQuantity"),
        )
        .orderBy(F.desc("TotalRevenue"), "StockCode", "Description")
        .limit(limit)
    )


def by_country(cleaned: DataFrame) -> DataFrame:
    return (
        per_order(cleaned, "Country")
        .groupBy("Country")
        .agg(
            total("Revenue").alias("TotalRevenue"),
            F.count_distinct("Customer ID").alias("UniqueCustomers"),
            F.count_distinct("Invoice").alias("TotalOrders"),
        )
        .orderBy(F.desc("TotalRevenue"), "Country")
    )


def rank_products(cleaned: DataFrame) -> DataFrame:
    """Products of each country by revenue. Most lines may come from one country, so the
    ranking inside a country is spread over tasks as well."""
    revenue = cleaned.groupBy("StockCode", "Description", "Country").agg(
        total("Revenue").alias("TotalRevenue")
    )
    return rank_within(revenue, "Country", "TotalRevenue", "RevenueRank").select(
        "StockCode", "Description", "Country", "TotalRevenue", "RevenueRank"
    )
