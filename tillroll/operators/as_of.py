"""As-of join: each row with the last earlier row of another table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.carry import carry_forward
from tillroll.functions.moments import micros


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    tie: Sequence[str] = (),
    inclusive: bool = False,
    within_seconds: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """All rows of ``left`` with ``columns`` of the last row of ``right`` that has the same
    ``keys`` and an earlier time; null where there is none.

    Both tables are put in one sequence and the rows of ``right`` are carried forward to those of
    ``left``: one sort instead of a join on an inequality, whose candidates grow with the square
    of a key. With ``inclusive`` a row of the same moment counts as earlier. Of rows of one
    moment the last by ``tie`` counts. With ``within_seconds`` older rows do not count. Null keys
    and moments match nothing. Columns of ``left`` are kept, whatever their names; ``columns``
    must not be among them.
    """
    first, second = (1, 0) if inclusive else (0, 1)
    ties = {f"_tie{i}": F.col(c) for i, c in enumerate(tie)}
    found = F.struct(F.col(right_time).alias("_since"), *columns)
    asking = F.struct(*(F.col(f"`{c}`") for c in left.columns))
    none = {name: right.select(c).schema[0].dataType for name, c in zip(ties, tie, strict=True)}
    left_rows = left.select(
        *(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)),
        F.col(left_time).alias("_at"),
        F.lit(first).alias("_kind"),
        *(F.lit(None).cast(kind).alias(name) for name, kind in none.items()),
        # Spreads rows of one key and moment over several parts.
        F.xxhash64(*(F.col(f"`{c}`") for c in left.columns)).alias("_salt"),
        asking.alias("_left"),
    )
    usable = F.col(right_time).isNotNull()
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    right_rows = right.where(usable).select(
        *(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)),
        F.col(right_time).alias("_at"),
        F.lit(second).alias("_kind"),
        *(c.alias(name) for name, c in ties.items()),
        F.lit(0).cast("bigint").alias("_salt"),
        found.alias("_right"),
    )
    together = left_rows.unionByName(right_rows, allowMissingColumns=True)
    joined = carry_forward(
        together,
        [f"_key{i}" for i in range(len(keys))],
        ["_at", "_kind", *ties, "_salt"],
        F.col("_right"),
        "_found",
        partitions,
    ).where(F.col("_left").isNotNull())
    taken = F.col("_found")
    if within_seconds is not None:
        age = micros(F.col("_at")) - micros(F.col("_found._since"))
        taken = F.when(age <= within_seconds * 1_000_000, taken)
    return joined.withColumn("_found", taken).select(
        *(F.col(f"_left.`{c}`").alias(c) for c in left.columns),
        *(F.col(f"_found.`{c}`").alias(c) for c in columns),
    )
