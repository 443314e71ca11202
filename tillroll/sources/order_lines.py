"""Raw invoice lines made from the order tables, with the defects real files have.

Every line item becomes a line. All columns are text, as they are in a CSV file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Country names by nation key 0 to 18; later nations keep their own name.
COUNTRIES = (
    "United Kingdom", "Germany", "France", "Spain", "Netherlands", "Belgium",
    "Switzerland", "Portugal", "Italy", "Norway", "USA", "Canada", "Brazil", "Japan",
    "China", "Singapore", "Hong Kong", "India", "Bahrain",
)
NO_COUNTRY_NATION = 24
# Lifts some customer ids above 32 bits.
LARGE_ID = 3_000_000_000

# The columns read. Naming them spares a job per table that would look them up.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, "
    "l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
}


def _every(key: str, step: int) -> Column:
    return F.col(key) % step == 0


def _country() -> Column:
    nation = F.col("n_nationkey")
    named = F.get(F.array(*(F.lit(name) for name in COUNTRIES)), nation)
    return F.when(nation != NO_COUNTRY_NATION, F.coalesce(named, F.col("n_name")))


def _orders(table) -> DataFrame:
    """What is the same for all lines of an order, made once per order."""
    number = F.col("o_orderkey").cast("string")
    hours = (F.col("o_orderkey") % 24).cast("int") * F.expr("INTERVAL '1' HOUR")
    moment = F.col("o_orderdate") + hours
    return (
        table("orders")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey",
            number.alias("_number"),
            F.when(_every("o_orderkey", 101), "bad")
            .otherwise(moment.cast("string"))
            .alias("InvoiceDate"),
            F.when(_every("o_custkey", 5), None)
            .when(_every("o_custkey", 13), "12d")
            .when(
                _every("o_custkey", 7),
                F.concat((F.col("o_custkey") + LARGE_ID).cast("string"), F.lit(".0")),
            )
            .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
            .alias("Customer ID"),
            _country().alias("Country"),
        )
    )


def _parts(table) -> DataFrame:
    return table("part").select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("StockCode"),
        F.when(~_every("p_partkey", 50), F.col("p_name")).alias("_name"),
        F.when(_every("p_partkey", 40), "0.0")
        .when(_every("p_partkey", 43), "0x1p3")
        .when(_every("p_partkey", 11), F.concat(F.col("p_retailprice").cast("string"), F.lit("0499")))
        .otherwise(F.col("p_retailprice").cast("string"))
        .alias("Price"),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")

    # Lines and orders both grow with the business, so they meet by shuffle and sort, where
    # a key with very many rows is split. For the other tables the planner decides: it
    # broadcasts one only when its file is small enough.
    lines = (
        table("lineitem")
        .join(_orders(table).hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_parts(table), F.col("l_partkey") == F.col("p_partkey"))
    )
    returned = F.col("l_returnflag") == "R"
    quantity = F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    raw = lines.select(
        F.when(returned, F.concat(F.lit("C"), "_number"))
        .otherwise(F.col("_number"))
        .alias("Invoice"),
        "StockCode",
        F.when(_every("l_orderkey", 3), F.concat(F.lit("  "), "_name", F.lit(" ")))
        .otherwise(F.col("_name"))
        .alias("Description"),
        F.when(_every("l_partkey", 97), "x10")
        .when(_every("l_partkey", 83), "10F")
        .when(_every("l_partkey", 89), None)
        .otherwise(quantity.cast("string"))
        .alias("Quantity"),
        "InvoiceDate",
        "Price",
        "Customer ID",
        "Country",
        # Some lines were sent twice.
        F.when(_every("l_orderkey", 31), 2).otherwise(1).alias("_times"),
    )
    copies = F.explode(F.array_repeat(F.lit(True), F.col("_times"))).alias("_copy")
    return raw.select("*", copies).drop("_times", "_copy")
