"""From a raw CSV to stored tables and reports in one run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import aggregates, cleaning, profiling, quality, reports, star
from tillroll.plans.warehouse import build_star
from tillroll.sources.invoice_csv import read_lines
from tillroll.sources.tables import write_report_csv, write_report_json, write_table

AGGREGATES = {
    "agg_monthly": aggregates.monthly,
    "agg_top_products": aggregates.top_products,
    "agg_by_country": aggregates.by_country,
    "agg_product_ranks": aggregates.rank_products,
}


def ingest(spark: SparkSession, source: str, out: str) -> DataFrame:
    return write_table(read_lines(spark, source), f"{out}/retail_raw")


def profile(raw: DataFrame, out: str) -> None:
    summary = write_table(profiling.ingest_summary(raw), f"{out}/ingest_summary")
    report = profiling.profile_report(raw, summary)
    write_report_json(report, f"{out}/data_profile_report")


def transform(raw: DataFrame, out: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Duplicates are removed once. The distinct lines are stored, because both the
    cleaned table and the counts per step come from them."""
    distinct = write_table(cleaning.distinct_lines(raw), f"{out}/retail_distinct")
    lines = cleaning.clean_distinct(distinct.drop(cleaning.COPIES))
    cleaned = write_table(lines, f"{out}/retail_cleaned", partition_by)
    write_report_csv(cleaning.step_counts(distinct), f"{out}/cleaning_steps")
    for name, build in AGGREGATES.items():
        write_table(build(cleaned), f"{out}/{name}")
    return cleaned


def validate(
    cleaned: DataFrame,
    out: str,
    suite: Sequence[quality.Expectation] = quality.RETAIL_SUITE,
) -> None:
    """Store the results, then raise if any check failed."""
    results = write_table(quality.expectations(cleaned, suite), f"{out}/expectations")
    integrity = write_table(
        quality.revenue_integrity(cleaned), f"{out}/revenue_integrity"
    )
    write_report_csv(quality.precheck(cleaned), f"{out}/precheck")
    quality.enforce(results, integrity)


def load(cleaned: DataFrame, out: str) -> dict[str, DataFrame]:
    """Each run replaces the tables, so running twice gives the same as running once.
    Raises :class:`~tillroll.operators.star.LoadError` if a key, reference or width is broken;
    what is broken is written first."""
    tables = build_star(
        cleaned, lambda df, name: write_table(df, f"{out}/warehouse/{name}")
    )
    write_report_csv(star.verify_load(tables), f"{out}/load_counts")
    violations = write_table(star.star_integrity(tables), f"{out}/star_integrity")
    star.enforce_integrity(violations)
    return tables


def export(tables: dict[str, DataFrame], out: str) -> None:
    fact = tables["fact_sales"]
    finished = {
        "dash_monthly": reports.export_monthly(fact, tables["dim_date"]),
        "dash_top_products": reports.export_top_products(fact, tables["dim_product"]),
        "dash_by_country": reports.export_by_country(fact, tables["dim_region"]),
    }
    for name, report in finished.items():
        write_report_csv(report, f"{out}/{name}")


def run(
    spark: SparkSession, source: str, out: str, partition_by: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Ingest, profile, clean and aggregate, validate, load, export. Stops before the load
    with :class:`~tillroll.operators.quality.QualityGateError` if a check fails."""
    raw = ingest(spark, source, out)
    profile(raw, out)
    cleaned = transform(raw, out, partition_by)
    validate(cleaned, out)
    tables = load(cleaned, out)
    export(tables, out)
    return tables
