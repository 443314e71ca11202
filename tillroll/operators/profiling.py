"""What raw invoice lines look like before any cleaning."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions import scalars
from tillroll.functions.ordering import quantiles

TOP_COUNTRIES = 5


def _quoted(df: DataFrame) -> list[Column]:
    return [F.col(f"`{name}`") for name in df.columns]


def _distinct_rows(raw: DataFrame) -> DataFrame:
    """Each different row once, with its number of copies. Nulls count as equal."""
    return raw.groupBy(*_quoted(raw)).agg(F.count("*").alias("_copies"))


def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0).cast("bigint"))


def required_columns(raw: DataFrame) -> DataFrame:
    """For each required column: is it there, and how many rows have a value in it."""
    counts = raw.agg(
        *(
            (F.count(f"`{name}`") if name in raw.columns else _or_zero(F.max(F.lit(None))))
            .alias(f"_{i}")
            for i, name in enumerate(schemas.RAW_COLUMNS)
        )
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(name in raw.columns).alias("present"),
                F.col(f"_{i}").alias("rows_with_value"),
            )
            for i, name in enumerate(schemas.RAW_COLUMNS)
        )
    )
    return counts.select(F.inline(rows))


def ingest_summary(raw: DataFrame) -> DataFrame:
    """Size, nulls, repeats, date range as text and countries.

    The countries are counted apart: in one aggregate with them, the smallest and largest
    text would make Spark sort the lines by country. Both aggregates read the same distinct
    rows, whose shuffle is made once.
    """
    nulls = reduce(lambda a, b: a + b, (c.isNull().cast("int") for c in _quoted(raw)))
    distinct = _distinct_rows(raw)
    counts = distinct.agg(
        _or_zero(F.sum("_copies")).alias("total_rows"),
        F.lit(len(raw.columns)).alias("total_columns"),
        _or_zero(F.sum(F.col("_copies") * nulls)).alias("null_values"),
        _or_zero(F.sum(F.col("_copies") - 1)).alias("duplicate_rows"),
        F.min("InvoiceDate").alias("date_min"),
        F.max("InvoiceDate").alias("date_max"),
    )
    # Reading the copies here as well keeps the two shuffles the same.
    country = F.when(F.col("_copies") > 0, F.col("Country"))
    countries = distinct.agg(F.count_distinct(country)).scalar()
    return counts.select("*", countries.alias("countries"))


def profile_shape(raw: DataFrame) -> DataFrame:
    counts = _distinct_rows(raw).agg(
        _or_zero(F.sum("_copies")).alias("total_rows"),
        F.lit(len(raw.columns)).alias("total_columns"),
        _or_zero(F.sum(F.col("_copies") - 1)).alias("duplicate_rows"),
    )
    return shape_of(counts, raw.columns)


def shape_of(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The shape from counts already taken, by ``ingest_summary`` for one."""
    duplicates, total = F.col("duplicate_rows"), F.col("total_rows")
    return counts.select(
        "total_rows",
        "total_columns",
        "duplicate_rows",
        scalars.percent(duplicates, total).alias("duplicate_pct"),
        F.lit(",".join(columns)).alias("columns"),
    )


def profile_nulls(raw: DataFrame) -> DataFrame:
    """One row per column, from one pass."""
    counts = raw.agg(
        F.count("*").alias("_rows"),
        *(F.count_if(c.isNull()).alias(f"_{i}") for i, c in enumerate(_quoted(raw))),
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"_{i}").alias("null_count"),
                scalars.percent(F.col(f"_{i}"), F.col("_rows")).alias("null_pct"),
            )
            for i, name in enumerate(raw.columns)
        )
    )
    return counts.select(F.inline(rows))


def profile_cancellations(raw: DataFrame) -> DataFrame:
    """Counts lines, not invoices, under the names the report uses."""
    counts = raw.agg(
        F.count("*").alias("total_invoices"),
        F.count_if(scalars.is_cancelled(F.col("Invoice"))).alias("cancelled_invoices"),
    )
    return counts.select(
        "*",
        scalars.percent(F.col("cancelled_invoices"), F.col("total_invoices")).alias(
            "cancellation_rate"
        ),
    )


def value_counts(raw: DataFrame, column: str) -> DataFrame:
    """Each different number in a column with its frequency.

    A number that fills a third of the column is merged inside each task first. All
    figures of a distribution come from this table, so the lines are read once.
    """
    return (
        raw.select(scalars.to_number(F.col(column)).alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count("*").alias("n"))
    )


def _count_where(test: Column) -> Column:
    return _or_zero(F.sum(F.when(test, F.col("n"))))


def _distribution(
    counts: DataFrame, tallies: dict[str, Column], points: dict[str, float]
) -> DataFrame:
    mean = F.sum(F.col("value") * F.col("n")) / F.sum("n")
    summary = counts.agg(
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.round(mean, 2).alias("mean"),
        *(_count_where(test).alias(name) for name, test in tallies.items()),
    )
    # One row, read as a scalar subquery.
    found = quantiles(counts, points).select(F.struct("*").alias("q")).scalar()
    return summary.select("*", found.alias("_q")).select(
        *summary.columns, *(F.col(f"_q.{name}").alias(name) for name in points)
    )


def profile_quantity(raw: DataFrame) -> DataFrame:
    value = F.col("value")
    return _distribution(
        value_counts(raw, "Quantity"),
        {"negative": value < 0, "zero": value == 0},
        {"median": 0.5, "p99": 0.99, "p999": 0.999},
    )


def profile_price(raw: DataFrame) -> DataFrame:
    """``below_001`` includes zero and negative prices."""
    value = F.col("value")
    return _distribution(
        value_counts(raw, "Price"),
        {"zero_or_neg": value <= 0, "below_001": value < schemas.MINIMUM_PRICE},
        {"p99": 0.99},
    )


def profile_scope(
    raw: DataFrame, layouts: Sequence[scalars.Layout] = (scalars.ISO,)
) -> DataFrame:
    """Dates and customers that are there but cannot be read have counts of their own. Dates may
    be written in any of ``layouts``."""
    when = scalars.to_wall_clock(F.col("InvoiceDate"), layouts)
    customer = F.col("Customer ID")
    return raw.agg(
        F.min(when).alias("date_min"),
        F.max(when).alias("date_max"),
        F.count_distinct("Customer ID").alias("unique_customers"),
        F.count_distinct("StockCode").alias("unique_products"),
        F.count_distinct("Country").alias("unique_countries"),
        F.count_if(F.col("InvoiceDate").isNotNull() & when.isNull()).alias("unreadable_dates"),
        F.count_if(customer.isNotNull() & scalars.to_integer(customer).isNull()).alias(
            "unreadable_customers"
        ),
    )


def top_countries(raw: DataFrame, limit: int = TOP_COUNTRIES) -> DataFrame:
    top = (
        raw.where(F.col("Country").isNotNull())
        .groupBy("Country")
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("cnt"), "Country")
        .limit(limit)
    )
    # Only the rows of the limit reach this window.
    order = Window.partitionBy().orderBy(F.desc("cnt"), "Country")
    return top.select(
        F.row_number().over(order).alias("rank"), F.col("Country").alias("country"), "cnt"
    )


def profile_report(raw: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """All sections as one row of nested columns, for the JSON sink.

    With a stored ``ingest_summary`` the lines are not compared a second time.
    """
    shape = profile_shape(raw) if summary is None else shape_of(summary, raw.columns)

    def one_row(section: DataFrame) -> Column:
        return section.select(F.struct("*")).scalar()

    def row_list(section: DataFrame) -> Column:
        """A sorted list; only for sections with a row per column or per top country."""
        return section.agg(F.sort_array(F.collect_list(F.struct("*")))).scalar()

    spark = raw.sparkSession
    return spark.range(1).select(
        F.current_timestamp().alias("profiled_at"),
        one_row(shape).alias("shape"),
        row_list(profile_nulls(raw)).alias("nulls"),
        one_row(profile_cancellations(raw)).alias("cancellations"),
        one_row(profile_quantity(raw)).alias("quantity"),
        one_row(profile_price(raw)).alias("price"),
        one_row(profile_scope(raw)).alias("scope"),
        row_list(top_countries(raw)).alias("top_countries"),
    )
