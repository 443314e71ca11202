"""Interval join: every overlapping pair once, without comparing all pairs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.moments import from_micros, micros

UNIT_SECONDS = 3600


def _level(unit: int) -> Column:
    """How often a bin of ``unit`` has to be doubled to be as long as the interval."""
    doublings = F.ceil(F.log2((F.col("_end") - F.col("_start")) / F.lit(float(unit))))
    return F.greatest(doublings, F.lit(0)).cast("int")


def _width(unit: int) -> Column:
    return (F.lit(float(unit)) * F.pow(F.lit(2.0), F.col("_on"))).cast("bigint")


def _measured(rows: DataFrame, prefix: str, start: str, end: str, keys: Sequence[str], unit: int):
    """The usable intervals, their columns under ``prefix``, and the levels that occur."""
    measured = (
        rows.select(
            *(F.col(key).alias(f"_key{i}") for i, key in enumerate(keys)),
            micros(F.col(start)).alias("_start"),
            micros(F.col(end)).alias("_end"),
            *(F.col(f"`{c}`").alias(f"{prefix}{c}") for c in rows.columns),
        )
        .where("_start < _end")
        .withColumn("_level", _level(unit))
    )
    levels = [r[0] for r in measured.select("_level").distinct().collect()]  # 64 at most
    return measured, levels


def _binned(rows: DataFrame, prefix: str, others: Sequence[int], unit: int) -> DataFrame:
    """A copy of each interval for its own level and for each higher one of the other table, in
    the bins that it touches there: two, or three at most, for each level."""
    higher = F.filter(F.array(*map(F.lit, others)), lambda level: level > F.col("_level"))
    levels = F.concat(F.array("_level"), higher.cast("array<int>"))
    width = _width(unit)
    first = (F.col("_start") - F.pmod("_start", width)) / width
    last = (F.col("_end") - 1 - F.pmod(F.col("_end") - 1, width)) / width
    return (
        rows.withColumn("_on", F.explode(levels))
        .withColumn("_bin", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))))
        # Where the bin begins and ends, so that a pair is only compared, not computed with.
        .withColumn("_from", F.col("_bin") * width)
        .withColumn("_to", F.col("_from") + width)
        .withColumnsRenamed(
            {c: f"_{prefix}{c}" for c in ("_start", "_end", "_level", "_from", "_to")}
        )
    )


def overlapping_pairs(
    left: DataFrame,
    right: DataFrame,
    start: str = "start",
    end: str = "end",
    keys: Sequence[str] = (),
    names: tuple[str, str] = ("left_", "right_"),
    unit_seconds: int = UNIT_SECONDS,
) -> DataFrame:
    """The pairs of half-open intervals that have a moment in common and the same ``keys``.

    Returns the columns of both tables, each under its prefix of ``names``, and
    ``overlap_start``, ``overlap_end`` and ``overlap_micros``, how long that is; a sum over pairs
    need not take moments apart again. Time is cut into bins whose width doubles from level to
    level. An interval belongs to the level whose bins are as long as itself, and a pair meets on
    the higher level of its two. There both touch a few bins only, so copies follow the number
    of levels, not the length of an interval; and of bins in common the one that has the first
    common moment owns the pair. The join is on equal level and bin, which the planner hashes,
    sorts and splits where a bin is crowded.

    Intervals that are empty, reversed or lack an end meet nothing; null keys match nothing.
    """
    unit = unit_seconds * 1_000_000
    a, b = names
    one, one_levels = _measured(left, a, start, end, keys, unit)
    two, two_levels = _measured(right, b, start, end, keys, unit)
    same = [*(f"_key{i}" for i in range(len(keys))), "_on", "_bin"]
    pairs = _binned(one, a, two_levels, unit).join(_binned(two, b, one_levels, unit), same)
    begin = F.greatest(f"_{a}_start", f"_{b}_start")
    close = F.least(f"_{a}_end", f"_{b}_end")
    rules = [
        F.greatest(f"_{a}_level", f"_{b}_level") == F.col("_on"),
        begin < close,
        (begin >= F.col(f"_{a}_from")) & (begin < F.col(f"_{a}_to")),
    ]
    return pairs.where(reduce(lambda x, y: x & y, rules)).select(
        *(f"`{a}{c}`" for c in left.columns),
        *(f"`{b}{c}`" for c in right.columns),
        from_micros(begin).alias("overlap_start"),
        from_micros(close).alias("overlap_end"),
        (close - begin).alias("overlap_micros"),
    )
