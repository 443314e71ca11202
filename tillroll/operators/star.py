"""Star schema: four dimensions, the sales fact and the checks on their keys."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions import scalars
from tillroll.functions.ordering import number_by_range, number_rows
from tillroll.sources.staging import stage

WEEKEND = (1, 7)


def _first_by_name(lines: DataFrame, key: str, value: str) -> DataFrame:
    """One row per ``key`` with the smallest ``value``; null only if there is no other.

    ``min`` of a text would sort the lines, and the optimizer drops a distinct step before
    it. Here distinct pairs, which are found by hashing and are far fewer than the lines,
    come first, and only they are sorted.
    """
    order = Window.partitionBy(key).orderBy(F.asc_nulls_last(value))
    return (
        lines.select(key, value)
        .distinct()
        .withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") == 1)
        .drop("_place")
    )


def dim_customer(cleaned: DataFrame) -> DataFrame:
    """One row per customer, guests included; of several countries the first by name."""
    lines = cleaned.select(
        F.col("Customer ID").alias("customer_id"), F.col("Country").alias("country")
    )
    return _first_by_name(lines, "customer_id", "country")


def dim_product(cleaned: DataFrame) -> DataFrame:
    """One row per code; of several descriptions the first by name."""
    lines = cleaned.select(
        F.col("StockCode").alias("stock_code"),
        F.col("Description").alias("description"),
    )
    return _first_by_name(lines, "stock_code", "description")


def dim_date(cleaned: DataFrame) -> DataFrame:
    """One row per moment, numbered in time order.

    Numbering goes day by day: no day has more than 86,400 different seconds, so no task
    gets more than that at once, whatever the number of sales.
    """
    moments = cleaned.select(F.col("InvoiceDate").alias("full_date")).distinct()
    day = F.coalesce(F.to_date("full_date"), F.lit("0001-01-01").cast("date"))
    numbered = number_rows(moments, "full_date", day, "date_id")
    weekday = F.dayofweek("full_date")
    return numbered.select(
        "date_id",
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.day("full_date").alias("day"),
        F.hour("full_date").alias("hour"),
        weekday.alias("weekday"),
        weekday.isin(*WEEKEND).alias("is_weekend"),
    )


def dim_region(cleaned: DataFrame) -> DataFrame:
    """One row per country, numbered by name."""
    countries = cleaned.select(F.col("Country").alias("country")).distinct()
    numbered = number_by_range(countries, "country", "region_id")
    return numbered.select(
        "region_id",
        "country",
        scalars.region_group(F.col("country")).alias("region_group"),
    )


def fact_sales(
    cleaned: DataFrame, dates: DataFrame | None = None, regions: DataFrame | None = None
) -> DataFrame:
    """One row per cleaned line with the keys of its date and region.

    A report that needs only one of the keys, or none, leaves the other dimension out: the
    optimizer could not drop a join whose key it does not know to be unique. The planner
    broadcasts a small dimension and shuffles for a large one, splitting a moment with very
    many sales. Null matches null.
    """
    keys = []
    if dates is not None:
        dates = dates.select("date_id", "full_date")
        same = F.col("InvoiceDate").eqNullSafe(F.col("full_date"))
        cleaned, keys = cleaned.join(dates, same, "left"), ["date_id"]
    if regions is not None:
        regions = regions.select("region_id", F.col("country").alias("_region"))
        same = F.col("Country").eqNullSafe(F.col("_region"))
        cleaned, keys = cleaned.join(regions, same, "left"), [*keys, "region_id"]
    return cleaned.select(
        F.col("Invoice").alias("invoice"),
        F.col("Customer ID").alias("customer_id"),
        F.col("StockCode").alias("stock_code"),
        *keys,
        F.col("Quantity").alias("quantity"),
        F.col("Price").alias("price"),
        F.col("Revenue").alias("revenue"),
    )


def with_sale_ids(fact: DataFrame) -> DataFrame:
    """Unique ids, given in each task without a shuffle. They depend on the partitioning,
    so call this only right before the fact is written."""
    return fact.select(F.monotonically_increasing_id().alias("sale_id"), "*")


class LoadError(RuntimeError):
    """The star schema breaks a rule of its keys, references or widths."""


def conform(table: DataFrame, name: str) -> DataFrame:
    """The columns of ``name`` in its schema's order and types; raises if one is missing."""
    schema = schemas.STAR_SCHEMAS[name]
    missing = [f.name for f in schema if f.name not in table.columns]
    if missing:
        raise LoadError(f"{name} lacks {', '.join(missing)}")
    return table.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def enforce_integrity(violations: DataFrame) -> None:
    """Raise if any rule is broken. A row per rule is all that reaches the driver."""
    broken = [
        f"{row['check']} of {row['table']}: {row['violations']}"
        for row in violations.where(F.col("violations") > 0).collect()
    ]
    if broken:
        raise LoadError("the load breaks " + "; ".join(broken))


def verify_load(star: Mapping[str, DataFrame]) -> DataFrame:
    counts = (
        star[name].agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table"), "rows"
        )
        for name in schemas.STAR_SCHEMAS
    )
    return reduce(DataFrame.unionByName, counts)


def _violations(check: str, table: str, count: Column) -> tuple[Column, ...]:
    return (
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        F.coalesce(count, F.lit(0).cast("bigint")).alias("violations"),
    )


def _key_counts(fact: DataFrame) -> DataFrame:
    """``rule``, ``key``, ``n``: how often each key of the fact is used, for all its rules, from
    one scan. For a width the key says whether a text is too long.

    A row becomes one for each rule, and these are counted in every task before the shuffle, so
    a key with very many sales is a row for each task by then."""
    uses = [(key, F.col(key).cast("string")) for key, _ in schemas.FOREIGN_KEYS]
    uses += [(key, F.col(key).cast("string")) for _, table, key in schemas.UNIQUE_KEYS if table == "fact_sales"]
    for column, width in schemas.TEXT_WIDTHS.get("fact_sales", {}).items():
        uses.append((f"width({column})", (F.length(column) > width).cast("string")))
    pairs = F.array(*(F.struct(F.lit(r).alias("rule"), k.alias("key")) for r, k in uses))
    return fact.select(F.inline(pairs)).groupBy("rule", "key").agg(F.count("*").alias("n"))


def star_integrity(star: Mapping[str, DataFrame]) -> DataFrame:
    """Broken keys, references and text widths, one row per rule.

    The fact is read once: the counts of its keys are stored, and all its rules read those.
    """
    results = []
    counts = stage(_key_counts(star["fact_sales"]), "key_counts")

    def of_fact(rule: str) -> DataFrame:
        return counts.where(F.col("rule") == rule).select("key", F.col("n").alias("_n"))

    for rule, table, key in schemas.UNIQUE_KEYS:
        if table == "fact_sales":
            copies = of_fact(key)
        else:
            copies = star[table].groupBy(F.col(key).alias("key")).agg(F.count("*").alias("_n"))
        extra = F.when(F.col("key").isNull(), F.col("_n")).otherwise(F.col("_n") - 1)
        results.append(
            copies.agg(F.sum(extra).alias("_v")).select(
                *_violations(f"{rule}({key})", table, F.col("_v"))
            )
        )
    for key, table in schemas.FOREIGN_KEYS:
        used = of_fact(key).where(F.col("key").isNotNull())
        known = star[table].select(F.col(key).cast("string").alias("key"))
        orphans = used.join(known, "key", "left_anti")
        results.append(
            orphans.agg(F.sum("_n").alias("_v")).select(
                *_violations(f"foreign_key({key})", "fact_sales", F.col("_v"))
            )
        )
    for table, widths in schemas.TEXT_WIDTHS.items():
        if table == "fact_sales":
            results += [
                of_fact(f"width({c})")
                .agg(F.sum(F.when(F.col("key") == "true", F.col("_n"))).alias("_v"))
                .select(*_violations(f"width({c})", table, F.col("_v")))
                for c in widths
            ]
            continue
        too_long = star[table].agg(
            *(F.count_if(F.length(c) > n).alias(c) for c, n in widths.items())
        )
        rows = F.array(
            *(F.struct(*_violations(f"width({c})", table, F.col(c))) for c in widths)
        )
        results.append(too_long.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, results)
