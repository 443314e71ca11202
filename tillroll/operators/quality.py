"""Checks on cleaned invoice lines, and the gate before the load."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXISTS = "column_exists"
NOT_NULL = "values_not_null"
BETWEEN = "values_between"
DISTINCT_BETWEEN = "distinct_count_between"

PENNIES_APART = 1


class QualityGateError(RuntimeError):
    """Some check failed, so nothing may be loaded."""


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str
    low: float | None = None
    high: float | None = None

    def within(self, value: Column) -> Column:
        """Inclusive; an open side has no bound."""
        bounds = [F.lit(True)]
        if self.low is not None:
            bounds.append(value >= self.low)
        if self.high is not None:
            bounds.append(value <= self.high)
        return reduce(lambda a, b: a & b, bounds)


# The columns and bounds a cleaned table must meet.
RETAIL_SUITE = (
    *(
        Expectation(EXISTS, column)
        for column in (
            "Invoice", "StockCode", "Description", "Quantity", "Price", "Customer ID",
            "Country", "Revenue", "InvoiceDate",
        )
    ),
    *(
        Expectation(NOT_NULL, column)
        for column in ("Invoice", "StockCode", "Quantity", "Price", "Revenue")
    ),
    Expectation(BETWEEN, "Quantity", 1, 100_000),
    Expectation(BETWEEN, "Price", 0.01, 50_000),
    Expectation(BETWEEN, "Revenue", low=0.0),
    Expectation(DISTINCT_BETWEEN, "Country", 1, 200),
)


def _missing(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def precheck(cleaned: DataFrame) -> DataFrame:
    nulls = [F.count_if(_missing(cleaned, name)) for name in cleaned.columns]
    return cleaned.agg(
        F.count("*").alias("total_rows"),
        reduce(lambda a, b: a + b, nulls).alias("null_values"),
        F.count_if(F.col("Quantity") < 0).alias("negative_quantity"),
        F.count_if(F.col("Price") < 0).alias("negative_price"),
        F.count_if(F.col("Revenue") <= 0).alias("zero_revenue"),
    )


def expectations(
    cleaned: DataFrame, suite: Sequence[Expectation] = RETAIL_SUITE
) -> DataFrame:
    """One row per expectation. The whole suite is one aggregate over one scan.

    Checks on values ignore nulls, except the one for nulls. A check on a column that is
    not there fails.
    """
    present = set(cleaned.columns)
    metrics = {"_rows": F.count("*")}
    for i, check in enumerate(suite):
        if check.kind == EXISTS or check.column not in present:
            continue
        missing = _missing(cleaned, check.column)
        value = F.col(f"`{check.column}`")
        if check.kind == NOT_NULL:
            metrics[f"_{i}"] = F.count_if(missing)
        elif check.kind == BETWEEN:
            metrics[f"_{i}"] = F.count_if(~missing & ~check.within(value))
        else:
            metrics[f"_{i}"] = F.count_distinct(value)
    measured = cleaned.agg(*(metric.alias(name) for name, metric in metrics.items()))

    nothing = F.lit(None).cast("bigint")
    rows = []
    for i, check in enumerate(suite):
        metric = F.col(f"_{i}")
        elements, unexpected, observed = nothing, nothing, nothing
        if check.kind == EXISTS or check.column not in present:
            success = F.lit(check.kind == EXISTS and check.column in present)
        elif check.kind == DISTINCT_BETWEEN:
            observed, success = metric, check.within(metric)
        else:
            elements, unexpected, success = F.col("_rows"), metric, metric == 0
        rows.append(
            F.struct(
                F.lit(check.kind).alias("expectation"),
                F.lit(check.column).alias("column"),
                elements.alias("element_count"),
                unexpected.alias("unexpected_count"),
                observed.alias("observed"),
                success.alias("success"),
            )
        )
    return measured.select(F.inline(F.array(*rows)))


def revenue_integrity(cleaned: DataFrame) -> DataFrame:
    """Lines whose revenue differs from quantity times price by more than a penny.

    Counted in whole numbers, not as the revenue itself was made: the price in units of
    10^-8, the product and the revenue in pennies. A product without revenue is a mismatch, and so
    is a line with quantity and price whose product is too large to be formed.
    """
    units = F.round(F.col("Price") * 1e8).try_cast("decimal(18,0)")
    product = (units * F.col("Quantity").cast("decimal(19,0)")).try_cast("decimal(30,0)")
    pennies = F.signum(product).cast("decimal(1,0)") * F.floor(
        (F.abs(product) + F.lit(500_000)) / F.lit(1_000_000).cast("decimal(7,0)")
    )
    gap = F.abs((F.col("Revenue") * 100).cast("decimal(33,0)") - pennies)
    formed = product.isNotNull()
    unchecked = F.col("Price").isNotNull() & F.col("Quantity").isNotNull() & ~formed
    wrong = (
        F.coalesce(gap > PENNIES_APART, F.lit(False))
        | (F.col("Revenue").isNull() & formed)
        | unchecked
    )
    counts = cleaned.agg(F.count_if(wrong).alias("mismatches"))
    return counts.select("mismatches", (F.col("mismatches") == 0).alias("passed"))


def validation_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("evaluated"),
        F.count_if("success").alias("successful"),
        F.bool_and("success").alias("all_passed"),
    )


def enforce(results: DataFrame, integrity: DataFrame) -> None:
    """Raise if an expectation or the revenue check failed. A row per expectation and one
    for revenue are all that reaches the driver."""
    failed = [
        f"{row.expectation}({row.column})"
        for row in results.where(~F.col("success")).collect()
    ]
    failed += [
        f"revenue_integrity({row.mismatches} lines)"
        for row in integrity.where(~F.col("passed")).collect()
    ]
    if failed:
        raise QualityGateError("validation failed: " + ", ".join(failed))
