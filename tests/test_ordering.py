"""Ranks, numbers and quantiles against brute force."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tillroll.functions.ordering import (
    BAND,
    _in_ranges,
    number_by_range,
    number_rows,
    quantiles,
    rank_within,
)
from tillroll.functions.scalars import order_band

POINTS = {"low": 0.01, "median": 0.5, "p99": 0.99, "p999": 0.999, "top": 1.0}


def exact_quantiles(spark, values):
    frame = spark.createDataFrame([(float(v),) for v in values], "value double")
    counts = frame.groupBy("value").agg(F.count("*").alias("n"))
    return quantiles(counts, POINTS).first().asDict()


def check_quantiles(spark, values):
    found = exact_quantiles(spark, values)
    for name, point in POINTS.items():
        assert np.isclose(found[name], np.quantile(values, point), rtol=1e-12), name


def test_quantiles_with_one_value_in_a_third_of_the_rows(spark):
    source = random.Random(1)
    values = [source.choice([-1, 1]) * source.lognormvariate(2, 3) for _ in range(4000)]
    check_quantiles(spark, values + [12.0] * 2000 + [0.0] * 50)


@settings(max_examples=8, deadline=None)
@given(values=st.lists(st.floats(-1e9, 1e9, allow_subnormal=True), min_size=1))
def test_quantiles_of_any_values(spark, values):
    check_quantiles(spark, values)


def test_quantiles_of_nothing(spark):
    counts = spark.createDataFrame([], "value double, n bigint")
    assert set(quantiles(counts, POINTS).first().asDict().values()) == {None}


def test_bands_never_fall(spark):
    source = random.Random(2)
    values = [0.0, 5e-324, 1e308, 1.7e308, float("inf")]
    values += [2.0**e for e in range(-1074, 1024)]
    values += [source.uniform(1, 2) * 2.0 ** source.randint(-300, 300) for _ in range(5000)]
    values = sorted({*values, *(-v for v in values)})
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    rows = frame.select("v", order_band(F.col("v")).alias("b")).collect()
    bands = [row.b for row in sorted(rows, key=lambda row: row.v)]
    assert bands == sorted(bands)
    assert max(bands) - min(bands) < 5000 * 16


def test_rank_with_ties_and_one_large_group(spark):
    source = random.Random(3)
    rows = [
        (source.choice(["a"] * 8 + ["b", "c"]), f"p{i}", source.randint(1, 400) / 100)
        for i in range(900)
    ]
    frame = spark.createDataFrame(rows, "g string, p string, v double").withColumn(
        "v", F.col("v").cast("decimal(28,2)")
    )
    for row in rank_within(frame, "g", "v", "r").collect():
        larger = sum(1 for g, _, v in rows if g == row.g and v > float(row.v))
        assert row.r == larger + 1


def test_rank_keeps_nulls_and_a_value_shared_by_most_rows(spark):
    rows = [("a", 5.0)] * 500 + [("a", 7.0), ("a", -1.0), ("a", None), (None, 2.0), (None, 2.0)]
    frame = spark.createDataFrame(rows, "g string, v double")
    found = sorted((r.g or "", r.v or 0, r.r) for r in rank_within(frame, "g", "v", "r").collect())
    assert found == sorted(
        [("a", 5.0, 2)] * 500
        + [("a", 7.0, 1), ("a", -1.0, 502), ("a", 0, 503), ("", 2.0, 1), ("", 2.0, 1)]
    )


def test_numbers_follow_the_key(spark):
    words = sorted({f"{c}{i}" for c in "abxyZ" for i in range(40)} | {""})
    frame = spark.createDataFrame([(w,) for w in words], "w string").repartition(5)
    numbered = number_rows(frame, "w", F.left("w", F.lit(1)), "n").collect()
    assert [r.w for r in sorted(numbered, key=lambda r: r.n)] == words
    assert sorted(r.n for r in numbered) == list(range(1, len(words) + 1))


def test_numbers_by_range_follow_the_key(spark):
    words = sorted({f"a{i:03}" for i in range(300)} | {"", "B", "é"}, key=str.encode)
    frame = spark.createDataFrame([(w,) for w in words], "w string").repartition(5)
    numbered = number_by_range(frame, "w", "n").collect()
    assert [r.w for r in sorted(numbered, key=lambda r: r.n)] == words
    assert sorted(r.n for r in numbered) == list(range(1, len(words) + 1))
    assert number_by_range(frame.limit(0), "w", "n").count() == 0


def test_ranges_follow_values_that_lie_close_together(spark):
    """200,000 revenues of one group within four percent: no task gets more than a small share."""
    frame = spark.range(200_000).select(
        F.lit("a").alias("g"), (F.lit(1000) + F.col("id") * 0.0002).alias("v")
    )
    sizes = _in_ranges(frame, "g", F.desc("v")).groupBy(BAND).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 200_000 / 4
    ranked = rank_within(frame, "g", "v", "r")
    assert ranked.where(F.col("r") != 200_000 - F.round((F.col("v") - 1000) / 0.0002)).count() == 0


def test_a_value_that_goes_on_over_ranges_keeps_its_rank(spark):
    """A third of the rows tie, and another third have no value: both are cut into ranges."""
    rows = [("a", float(i)) for i in range(2000)] + [("a", 700.5)] * 3000 + [("a", None)] * 3000
    rows += [("b", 1.0)] * 40 + [(None, None)] * 9
    frame = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(rows)], "g string, v double, i int")
    ranges = _in_ranges(frame, "g", F.desc_nulls_last("v"), F.xxhash64("g", "v", "i"))
    assert ranges.where("v = 700.5").select(BAND).distinct().count() > 1
    found = {(r.g, r.v, r.r) for r in rank_within(frame, "g", "v", "r").collect()}
    want = {("a", float(i), 2000 - i + 3000 * (i < 700.5)) for i in range(2000)}
    assert found == want | {("a", 700.5, 1300), ("a", None, 5001), ("b", 1.0, 1), (None, None, 1)}
