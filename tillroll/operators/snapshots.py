"""What has changed between two loads of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ADDED, REMOVED, CHANGED, KEPT, REPEATED = "added", "removed", "changed", "kept", "repeated"
#: Types whose values are compared themselves.
ITSELF = (
    T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType,
    T.TimestampNTZType,
)


def _digests(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit numbers for a row. Hashing skips nulls, so where they are is hashed too."""
    named = [F.col(f"`{c}`") for c in columns]
    nulls = F.concat(F.lit(""), *(c.isNull().cast("int").cast("string") for c in named))
    return [F.xxhash64(F.lit(seed), nulls, *named) for seed in (1, 2)]


def _value(rows: DataFrame, name: str) -> Column:
    """What stands for a column in a key with one row: numbers and moments for themselves, as
    they pack better than hashes; of anything else a 64-bit hash."""
    column, kind = F.col(f"`{name}`"), rows.schema[name].dataType
    short = isinstance(kind, T.DecimalType) and kind.precision <= 18
    if short or isinstance(kind, ITSELF):
        return F.max(column)
    return F.bit_xor(F.xxhash64(column.isNull(), column))


def _by_key(rows: DataFrame, key: Sequence[str], values: Sequence[str], side: str) -> DataFrame:
    """A row for each key: how many rows, a digest of all of them that does not depend on their
    order, and a value of each column. Only numbers, added up by hashing in every task before the
    shuffle, whatever the columns hold. Halves of 32 bits are added up apart, as bigint."""
    halves = [
        half
        for digest in _digests(values)
        for half in (F.shiftright(digest, 32), digest.bitwiseAND(F.lit((1 << 32) - 1)))
    ]
    return rows.groupBy(F.struct(*(F.col(f"`{c}`") for c in key)).alias("_key")).agg(
        F.count(F.lit(1)).alias(f"_rows_{side}"),
        *(F.sum(half).alias(f"_sum_{side}_{i}") for i, half in enumerate(halves)),
        *(_value(rows, c).alias(f"_{side}_{i}") for i, c in enumerate(values)),
    )


def changes_by_key(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys whose rows differ: the key, ``status``, ``rows_before``, ``rows_after`` and
    ``changed_columns``.

    Keys need not be unique: the rows of a key are compared as a multiset, by their number and a
    128-bit digest. Null is equal to null, in keys and values. A key with one row in each load
    names the columns that differ, other than numbers and moments by 64-bit hashes; others null. Both loads must have the same columns.
    """
    values = [c for c in before.columns if c not in key]
    # Keys are structs: these are joined with null equal to null, and on the same hashing that
    # the aggregates used, so the join moves nothing.
    joined = _by_key(before, key, values, "b").join(_by_key(after, key, values, "a"), "_key", "full")
    names = F.array(
        *(
            F.when(~F.col(f"_b_{i}").eqNullSafe(F.col(f"_a_{i}")), F.lit(c))
            for i, c in enumerate(values)
        )
    )
    single = (F.col("_rows_b") == 1) & (F.col("_rows_a") == 1)
    status = (
        F.when(F.col("_rows_b").isNull(), ADDED)
        .when(F.col("_rows_a").isNull(), REMOVED)
        .when(
            (F.col("_rows_b") != F.col("_rows_a"))
            | reduce(or_, (F.col(f"_sum_b_{i}") != F.col(f"_sum_a_{i}") for i in range(4))),
            CHANGED,
        )
    )
    return (
        joined.withColumn("status", status)
        .where(F.col("status").isNotNull())
        .select(
            *(F.col(f"_key.`{c}`").alias(c) for c in key),
            "status",
            F.coalesce("_rows_b", F.lit(0).cast("bigint")).alias("rows_before"),
            F.coalesce("_rows_a", F.lit(0).cast("bigint")).alias("rows_after"),
            F.when(single, F.array_compact(names)).alias("changed_columns"),
        )
    )


def changes_by_row(before: DataFrame, after: DataFrame, digests: bool = False) -> DataFrame:
    """Whole rows as multisets: all columns with ``rows_before`` and ``rows_after``.

    One aggregate over both loads, null equal to null; equal rows are counted in every task
    before the shuffle. With ``digests`` a row is told by 128 bits, ``digest_1`` and ``digest_2``,
    which stand in place of its columns: enough to count, and all that is moved."""
    columns = before.columns
    after = after.select(columns)
    if digests:
        named = [d.alias(f"digest_{i + 1}") for i, d in enumerate(_digests(columns))]
        before, after = before.select(named), after.select(named)
    counted = [
        rows.select("*", F.lit(b).alias("_b"), F.lit(a).alias("_a"))
        for rows, b, a in ((before, 1, 0), (after, 0, 1))
    ]
    return (
        counted[0]
        .unionByName(counted[1])
        .groupBy(*(F.col(f"`{c}`") for c in before.columns))
        .agg(F.sum("_b").alias("rows_before"), F.sum("_a").alias("rows_after"))
    )


def change_summary(rows: DataFrame) -> DataFrame:
    """Of ``changes_by_row``: how many rows were added, removed and kept, and how many of the
    later load repeat another, with the number of different rows of each kind."""
    b, a = F.col("rows_before"), F.col("rows_after")
    kinds = F.array(
        *(
            F.struct(F.lit(name).alias("status"), F.greatest(number, F.lit(0)).alias("n"))
            for name, number in (
                (ADDED, a - b), (REMOVED, b - a), (KEPT, F.least(a, b)), (REPEATED, a - 1),
            )
        )
    )
    return (
        rows.select(F.inline(kinds))
        .groupBy("status")
        .agg(F.sum("n").alias("rows"), F.count_if(F.col("n") > 0).alias("different"))
    )
