"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import (
    aggregates,
    cleaning,
    history,
    pivots,
    profiling,
    quality,
    reports,
    rollups,
    snapshots,
    star,
)
from tillroll.plans.event_catalog import QUERIES as EVENT_QUERIES
from tillroll.plans.warehouse import build_star
from tillroll.sources.invoice_csv import read_lines
from tillroll.sources.order_lines import order_lines
from tillroll.sources.staging import new_folder, stage

Query = Callable[[SparkSession, str], DataFrame]
Step = Callable[[DataFrame], DataFrame]


def _on_raw(step: Step) -> Query:
    return lambda spark, folder: step(order_lines(spark, folder))


def _on_typed(step: Step) -> Query:
    return _on_raw(lambda raw: step(cleaning.fix_types(raw)))


def _on_cleaned(step: Step) -> Query:
    return _on_raw(lambda raw: step(cleaning.clean(raw)))


def _on_stored(step: Step) -> Query:
    """For steps that read the cleaned lines more than once: store them first."""
    return _on_cleaned(lambda cleaned: step(stage(cleaned, "cleaned")))


def _on_star(step: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return _on_stored(lambda cleaned: step(build_star(cleaned, stage)))


# The reports join only what they read and store nothing: the cleaned lines come to every
# reader from the one shuffle that removes duplicates.


def _fact_sales(cleaned: DataFrame) -> DataFrame:
    return star.fact_sales(cleaned, star.dim_date(cleaned), star.dim_region(cleaned))


def _export_monthly(cleaned: DataFrame) -> DataFrame:
    dates = star.dim_date(cleaned)
    return reports.export_monthly(star.fact_sales(cleaned, dates=dates), dates)


def _export_top_products(cleaned: DataFrame) -> DataFrame:
    return reports.export_top_products(star.fact_sales(cleaned), star.dim_product(cleaned))


def _export_by_country(cleaned: DataFrame) -> DataFrame:
    regions = star.dim_region(cleaned)
    return reports.export_by_country(star.fact_sales(cleaned, regions=regions), regions)


def _csv_ingest(raw: DataFrame) -> DataFrame:
    """The raw lines written to CSV files and read back as an input would be."""
    path = new_folder(raw.sparkSession, "lines_csv")
    raw.write.csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return read_lines(raw.sparkSession, path)


def _later_load(cleaned: DataFrame) -> DataFrame:
    """The cleaned lines as a second load might have them, with changes by product number: some
    products gone, some recounted, some without description, some lines twice, some new."""
    code = F.col("StockCode").cast("bigint")
    later = cleaned.where(code % 17 != 0).withColumns(
        {
            "Quantity": F.when(code % 19 == 0, F.col("Quantity") + 1).otherwise(F.col("Quantity")),
            "Description": F.when(code % 23 != 0, F.col("Description")),
        }
    )
    twice = later.where(code % 29 == 0)
    new = later.where(code % 31 == 0).withColumn("Invoice", F.concat(F.lit("N"), "Invoice"))
    return later.unionByName(twice).unionByName(new)


def _load_changes(cleaned: DataFrame) -> DataFrame:
    key = ["Invoice", "StockCode"]
    changes = snapshots.changes_by_key(cleaned, _later_load(cleaned), key)
    return changes.withColumn("changed_columns", F.array_join("changed_columns", ","))


def _load_summary(cleaned: DataFrame) -> DataFrame:
    rows = snapshots.changes_by_row(cleaned, _later_load(cleaned), digests=True)
    return snapshots.change_summary(rows)


def _region_months(cleaned: DataFrame) -> DataFrame:
    return pivots.pivot(
        rollups.with_region(cleaned),
        ["Year", "Month"],
        "Region",
        F.col("Revenue"),
        F.lit(0).cast("decimal(38,2)"),
    )


def _activity_runs(cleaned: DataFrame) -> DataFrame:
    return history.activity_runs(history.customer_days(cleaned))


QUERIES: dict[str, Query] = {
    # Sources
    "csv_ingest": _on_raw(_csv_ingest),
    "required_columns": _on_raw(profiling.required_columns),
    # Profile
    "ingest_summary": _on_raw(profiling.ingest_summary),
    "profile_shape": _on_raw(profiling.profile_shape),
    "profile_nulls": _on_raw(profiling.profile_nulls),
    "profile_cancellations": _on_raw(profiling.profile_cancellations),
    "profile_quantity": _on_raw(profiling.profile_quantity),
    "profile_price": _on_raw(profiling.profile_price),
    "profile_scope": _on_raw(profiling.profile_scope),
    "top_countries": _on_raw(profiling.top_countries),
    # Cleaning, each step on its own and then the chain
    "fix_types": _on_raw(cleaning.fix_types),
    "dedup": _on_typed(cleaning.remove_duplicates),
    "drop_nulls": _on_typed(cleaning.drop_incomplete),
    "fill_nulls": _on_typed(cleaning.fill_defaults),
    "filter_bad_data": _on_typed(cleaning.keep_sales),
    "derived_columns": _on_typed(cleaning.add_derived),
    "step_counts": _on_raw(
        lambda raw: cleaning.step_counts(cleaning.distinct_lines(raw))
    ),
    "cleaned": _on_raw(cleaning.clean),
    # Aggregates
    "monthly": _on_cleaned(aggregates.monthly),
    "top_products": _on_cleaned(aggregates.top_products),
    "by_country": _on_cleaned(aggregates.by_country),
    "rank_products": _on_cleaned(aggregates.rank_products),
    # Quality
    "precheck": _on_cleaned(quality.precheck),
    "expectations": _on_cleaned(quality.expectations),
    "revenue_integrity": _on_cleaned(quality.revenue_integrity),
    "validation_summary": _on_cleaned(
        lambda cleaned: quality.validation_summary(quality.expectations(cleaned))
    ),
    # Star schema
    "dim_customer": _on_cleaned(star.dim_customer),
    "dim_product": _on_cleaned(star.dim_product),
    "dim_date": _on_cleaned(star.dim_date),
    "dim_region": _on_cleaned(star.dim_region),
    "fact_sales": _on_cleaned(_fact_sales),
    "star_integrity": _on_star(star.star_integrity),
    "verify_load": _on_star(star.verify_load),
    # Reports
    "export_monthly": _on_cleaned(_export_monthly),
    "export_top_products": _on_cleaned(_export_top_products),
    "export_by_country": _on_cleaned(_export_by_country),
    # Several levels at once, and two loads compared
    "sales_rollup": _on_cleaned(rollups.sales_rollup),
    "sales_cube": _on_cleaned(rollups.sales_cube),
    "sales_grouping_sets": _on_cleaned(rollups.sales_grouping_sets),
    "pivot_region_months": _on_stored(_region_months),
    "customer_days": _on_cleaned(history.customer_days),
    "activity_runs": _on_cleaned(_activity_runs),
    "load_changes": _on_stored(_load_changes),
    "load_change_summary": _on_stored(_load_summary),
    # Events
    **EVENT_QUERIES,
}
