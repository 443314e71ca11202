"""As-of and interval joins against plain loops, and what their plans hold."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tillroll.functions.carry import carry_forward
from tillroll.functions.scalars import exact_sum
from tillroll.operators.as_of import as_of_join
from tillroll.operators.intervals import overlapping_pairs

START = datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else START + timedelta(minutes=minutes)


def plan(frame):
    return frame._jdf.queryExecution().toString()


def brute_as_of(left, right, inclusive, within):
    out = Counter()
    for name, key, when in left:
        fits = [
            (since, tie, label)
            for key2, since, tie, label in right
            if None not in (key, when, key2, since)
            and key == key2
            and (since < when or inclusive and since == when)
        ]
        best = max(fits, default=None)
        if best and within is not None and (when - best[0]) > within:
            best = None
        out[name, key, when, best and best[2]] += 1
    return out


@pytest.mark.parametrize("partitions", [1, 3, 16])
@pytest.mark.parametrize(("inclusive", "within"), [(False, None), (True, None), (True, 90), (False, 30)])
def test_as_of_against_loops(spark, partitions, inclusive, within):
    rng = random.Random(partitions)
    key = lambda: rng.choice([1, 1, 1, 2, 3, 4, None])  # noqa: E731  a hot key and none
    left = [(i, key(), rng.choice([None, *range(400)])) for i in range(150)]
    left += [(900 + i, 1, 77) for i in range(60)]  # many rows of one key and moment
    right = [(key(), rng.choice([None, *range(400)]), i, f"e{i}") for i in range(150)]
    right += [(1, 77, 500, "late"), (1, 77, 499, "early")]
    one = spark.createDataFrame([(n, k, at(m)) for n, k, m in left], "name int, key int, ts timestamp_ntz")
    two = spark.createDataFrame(
        [(k, at(m), t, lab) for k, m, t, lab in right], "key int, since timestamp_ntz, tie int, label string"
    )
    clash = ("_at", "_kind", "_salt", "_part", "_found", "_left", "_right", "_value", "since", "tie")
    joined = as_of_join(
        one.withColumns({c: F.lit("clash") for c in clash}), two, ["key"], "ts", "since", ["label"],
        tie=["tie"], inclusive=inclusive, within_seconds=within and within * 60, partitions=partitions,
    )
    assert {*clash} < {*joined.columns}
    found = Counter((r.name, r.key, r.ts, r.label) for r in joined.collect())
    assert found == Counter(
        {(n, k, at(m), lab): c for (n, k, m, lab), c in brute_as_of(left, right, inclusive, within).items()}
    )


def test_as_of_with_empty_tables(spark):
    one = spark.createDataFrame([(1, START)], "key int, ts timestamp_ntz")
    two = spark.createDataFrame([(1, START, "x")], "key int, since timestamp_ntz, label string")
    join = lambda a, b: as_of_join(a, b, ["key"], "ts", "since", ["label"]).collect()
    assert [r.label for r in join(one, two.limit(0))] == [None]
    assert join(one.limit(0), two) == []


def test_a_hot_key_is_cut_into_parts_and_carried_over(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") < 4000, 1).otherwise(F.col("id")).alias("key"),
        F.col("id").alias("place"),
        F.when(F.col("id") % 1500 == 0, F.col("id")).alias("seen"),
    )
    done = carry_forward(rows, ["key"], ["place"], F.col("seen"), "last", partitions=8)
    hot = done.where("key = 1").collect()
    assert len(hot) == 4000 and all(r["last"] == r.place // 1500 * 1500 for r in hot)
    text = plan(done)
    assert "BroadcastHashJoin" in text and "SinglePartition" not in text
    # Windows work by part and key; the parts hold a like number of rows each.
    assert "hashpartitioning(_part" in text


def brute_pairs(left, right):
    return Counter(
        (a[0], b[0], max(a[2], b[2]), min(a[3], b[3]))
        for a in left
        for b in right
        if None not in (a[1], b[1], *a[2:], *b[2:])
        and a[1] == b[1] and a[2] < a[3] and b[2] < b[3] and a[2] < b[3] and b[2] < a[3]
    )


def intervals(rng, count, longest):
    out = []
    for i in range(count):
        start = rng.randrange(-3000, 3000)
        end = start + int(rng.choice([1, 10, 60, 61, 120, longest]) * rng.random()) + rng.choice([-1, 0, 1])
        out.append((i, rng.choice([1, 1, 2, None]), start, end))
    return out + [(900, 1, None, 5), (901, 1, 5, None), (902, 1, -3000, 3000), (903, 2, 0, 60)]


@pytest.mark.parametrize("unit", [60, 3600, 86_400 * 30])
@pytest.mark.parametrize("longest", [30, 5000])
def test_pairs_against_loops(spark, unit, longest):
    rng = random.Random(unit + longest)
    left, right = intervals(rng, 120, longest), intervals(rng, 90, 300)
    schema = "name int, key int, begin timestamp_ntz, close timestamp_ntz, _level string"
    frames = [
        spark.createDataFrame([(n, k, at(s), at(e), "clash") for n, k, s, e in rows], schema)
        for rows in (left, right)
    ]
    found = overlapping_pairs(*frames, "begin", "close", ["key"], ("a_", "b_"), unit_seconds=unit)
    got = Counter((r.a_name, r.b_name, r.overlap_start, r.overlap_end) for r in found.collect())
    assert got == Counter({(x, y, at(s), at(e)): n for (x, y, s, e), n in brute_pairs(left, right).items()})
    text = plan(found)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_copies_follow_levels_and_not_lengths(spark):
    long = spark.createDataFrame([(at(0), at(10**7))], "start timestamp_ntz, end timestamp_ntz")
    short = spark.createDataFrame([(at(m), at(m + 5)) for m in range(0, 1000, 10)], long.schema)
    from tillroll.operators import intervals as module

    unit = 60 * 1_000_000
    a, a_levels = module._measured(long, "a_", "start", "end", (), unit)
    b, b_levels = module._measured(short, "b_", "start", "end", (), unit)
    assert module._binned(a, "a_", b_levels, unit).count() <= 3
    assert module._binned(b, "b_", a_levels, unit).count() <= 100 * 3 * 2
    assert overlapping_pairs(long, short, unit_seconds=60).count() == 100
    assert overlapping_pairs(long, short.limit(0)).count() == 0


def test_how_long_pairs_overlap_and_sums_beyond_64_bits(spark):
    schema = "start timestamp_ntz, end timestamp_ntz"
    one = spark.createDataFrame([(at(0), at(90)), (at(200), at(260))], schema)
    two = spark.createDataFrame([(at(30), at(240))], schema)
    pairs = overlapping_pairs(one, two)
    assert sorted(r.overlap_micros for r in pairs.collect()) == [40 * 60_000_000, 60 * 60_000_000]
    rows = [(1, 2**63 - 1), (1, 2**63 - 1), (1, -5), (2, -(2**63)), (2, -(2**63)), (3, None)]
    sums = spark.createDataFrame(rows, "k int, x bigint").groupBy("k").agg(exact_sum(F.col("x")).alias("s"))
    assert sums.schema["s"].dataType.simpleString() == "decimal(38,0)"
    assert {r.k: r.s for r in sums.collect()} == {1: 2**64 - 7, 2: -(2**64), 3: None}
