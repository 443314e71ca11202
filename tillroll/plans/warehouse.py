"""The star schema built from cleaned lines through stored tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tillroll import schemas
from tillroll.operators import star
from tillroll.sources.tables import append_jdbc

Store = Callable[[DataFrame, str], DataFrame]

DIMENSIONS = {
    "dim_customer": star.dim_customer,
    "dim_product": star.dim_product,
    "dim_date": star.dim_date,
    "dim_region": star.dim_region,
}


def build_star(cleaned: DataFrame, store: Store) -> dict[str, DataFrame]:
    """Store the dimensions, then the fact, each in the schema it is declared with.
    ``cleaned`` should itself be a stored table, because each of the five reads it."""
    tables = {
        name: store(star.conform(build(cleaned), name), name)
        for name, build in DIMENSIONS.items()
    }
    fact = star.fact_sales(cleaned, tables["dim_date"], tables["dim_region"])
    fact = star.conform(star.with_sale_ids(fact), "fact_sales")
    tables["fact_sales"] = store(fact, "fact_sales")
    return tables


def append_to_database(
    tables: Mapping[str, DataFrame], url: str, properties: Mapping[str, str]
) -> None:
    """Append the star schema to a database that has its tables, dimensions first because
    the fact refers to them."""
    for name in schemas.STAR_SCHEMAS:
        append_jdbc(tables[name], url, name, properties)
