"""Pivot with columns that are found in the data, and a bound on their number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_COLUMNS = 100
NULL_NAME = "null"


class PivotError(ValueError):
    """The column to pivot by has too many values, or two of one name."""


def pivot_values(rows: DataFrame, column: str, most: int = MOST_COLUMNS) -> list:
    """The different values in ascending order, null last; raises beyond ``most`` of them,
    of which no more than one further reaches the driver."""
    found = [r[0] for r in rows.select(column).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise PivotError(f"{column} has more than {most} values")
    return sorted(v for v in found if v is not None) + [None] * (None in found)


def pivot(
    rows: DataFrame,
    keys: Sequence[str],
    column: str,
    amount: Column,
    zero: Column | None = None,
    most: int = MOST_COLUMNS,
) -> DataFrame:
    """A row for each of ``keys``, a column for each value of ``column``: the sum of ``amount``.

    The values are found first, with a bound; then one aggregate makes all columns, as a sum
    for each of them, and adds up in every task before its one shuffle. Cells without rows are
    null, or ``zero``. Columns are called like the values; null is called ``null``.
    """
    values = pivot_values(rows, column, most)
    names = [NULL_NAME if v is None else str(v) for v in values]
    clash = {*keys} & {*names} or {n for n in names if names.count(n) > 1}
    if clash:
        raise PivotError(f"columns named twice: {', '.join(sorted(clash))}")
    cells = []
    for value, name in zip(values, names, strict=True):
        cell = F.sum(F.when(F.col(column).eqNullSafe(F.lit(value)), amount))
        cells.append((cell if zero is None else F.coalesce(cell, zero)).alias(name))
    grouped = rows.groupBy(*keys)
    return grouped.agg(*cells) if cells else grouped.agg(F.lit(0).alias("_")).drop("_")
