"""Typing, cleaning and enriching raw invoice lines."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import schemas
from tillroll.functions import scalars


COPIES = "_copies"


def _all(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def fix_types(
    lines: DataFrame, layouts: Sequence[scalars.Layout] = (scalars.ISO,)
) -> DataFrame:
    """Text to typed columns; what cannot be read becomes null in any ANSI mode. Dates may be
    written in any of ``layouts``."""
    return lines.withColumns(
        {
            "Quantity": scalars.to_integer(F.col("Quantity")),
            "Price": scalars.to_number(F.col("Price")),
            "Customer ID": scalars.to_integer(F.col("Customer ID")),
            "InvoiceDate": scalars.to_wall_clock(F.col("InvoiceDate"), layouts),
        }
    )


def remove_duplicates(lines: DataFrame) -> DataFrame:
    """Whole-row distinct. Copies are merged inside each task before the shuffle, so a row
    repeated very often does not pile up in one place."""
    return lines.dropDuplicates()


def _has_values(lines: DataFrame) -> list[Column]:
    """One test per critical column, so that each can move to the scan on its own."""
    tests = []
    for name in schemas.CRITICAL_COLUMNS:
        tests.append(F.col(name).isNotNull())
        if isinstance(lines.schema[name].dataType, (T.DoubleType, T.FloatType)):
            tests.append(~F.isnan(name))
    return tests


def drop_incomplete(lines: DataFrame) -> DataFrame:
    return lines.where(_all(_has_values(lines)))


def fill_defaults(lines: DataFrame) -> DataFrame:
    return lines.fillna(
        {
            "Description": schemas.UNKNOWN_TEXT,
            "Country": schemas.UNKNOWN_TEXT,
            "Customer ID": schemas.GUEST_CUSTOMER,
        }
    )


def _sale_tests():
    return (
        ("drop_cancellations", ~scalars.is_cancelled(F.col("Invoice"))),
        ("positive_quantity", F.col("Quantity") > 0),
        ("minimum_price", F.col("Price") >= schemas.MINIMUM_PRICE),
    )


def keep_sales(lines: DataFrame) -> DataFrame:
    """Without cancellations, non-positive quantities and prices below a penny."""
    for _, test in _sale_tests():
        lines = lines.where(test)
    return lines


def add_derived(lines: DataFrame) -> DataFrame:
    when = F.col("InvoiceDate")
    return lines.withColumns(
        {
            "Revenue": scalars.line_revenue(F.col("Quantity"), F.col("Price")),
            "Year": F.year(when),
            "Month": F.month(when),
            "Day": F.day(when),
            "Hour": F.hour(when),
            "Weekday": F.dayofweek(when),
            "Description": F.trim(F.upper(F.col("Description"))),
        }
    )


def clean_distinct(distinct: DataFrame) -> DataFrame:
    """The steps after the duplicates are gone. None of them shuffles."""
    return (
        distinct.transform(drop_incomplete)
        .transform(fill_defaults)
        .transform(keep_sales)
        .transform(add_derived)
    )


def clean(
    raw: DataFrame, layouts: Sequence[scalars.Layout] = (scalars.ISO,)
) -> DataFrame:
    """The whole chain. Types come first so that equal values count as duplicates however
    they were written; the optimizer moves the filters below the distinct step again."""
    typed = fix_types(raw, layouts)
    return typed.transform(remove_duplicates).transform(clean_distinct)


def distinct_lines(raw: DataFrame) -> DataFrame:
    """Typed lines without duplicates and, in ``_copies``, how often each was there."""
    typed = fix_types(raw)
    return typed.groupBy(*(F.col(f"`{c}`") for c in typed.columns)).agg(
        F.count("*").alias(COPIES)
    )


def step_counts(distinct: DataFrame) -> DataFrame:
    """Rows going in and coming out of each row-removing step, from one pass over
    ``distinct_lines``."""
    complete = _all(_has_values(distinct))
    steps = ["remove_duplicates", "drop_incomplete"]
    remaining = [F.sum(COPIES), F.count("*"), F.count_if(complete)]
    passed = complete
    for name, test in _sale_tests():
        passed = passed & test
        steps.append(name)
        remaining.append(F.count_if(passed))
    totals = distinct.agg(
        *(F.coalesce(n, F.lit(0)).alias(f"_n{i}") for i, n in enumerate(remaining))
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(step).alias("step"),
                F.col(f"_n{i}").alias("rows_in"),
                F.col(f"_n{i + 1}").alias("rows_out"),
            )
            for i, step in enumerate(steps)
        )
    )
    return totals.select(F.inline(rows))
