"""Windows and sessions: streams against tables, late rows, hot users, odd rows."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from tillroll.functions.moments import micros, to_clock, to_instant
from tillroll.sources.events import EVENTS, as_runs
from tillroll.streaming import event_windows as ew
from tillroll.streaming import sessions as se
from tillroll.streaming.runs import run_available, state_partitions

START = datetime(2024, 3, 9, 20, 0)  # a spring night on which clocks change in some zones


def events(spark, rows):
    """Rows of (minutes after START, user, type); values are in cents."""
    made = [
        (i, START + timedelta(minutes=m) if m is not None else None, u, t, i / 100, None)
        for i, (m, u, t) in enumerate(rows)
    ]
    return spark.createDataFrame(made, EVENTS)


@pytest.fixture
def new_york(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def test_moments_do_not_depend_on_the_zone(spark, new_york):
    rows = [(datetime(2024, 3, 10, 2, 30, 0, 123456),), (datetime(1969, 12, 31, 23, 59, 59, 999999),), (None,)]
    frame = spark.createDataFrame(rows, "t timestamp_ntz")
    found = frame.select("t", micros(F.col("t")).alias("m"), to_clock(to_instant(F.col("t"))).alias("b"))
    assert [tuple(r) for r in found.collect()] == [
        (rows[0][0], 1710037800123456, rows[0][0]), (rows[1][0], -1, rows[1][0]), (None, None, None),
    ]


def test_windows_of_a_table(spark, new_york):
    frame = events(spark, [(0, 1, "a"), (59, 1, "a"), (60, 1, "a"), (390, 2, None), (None, 1, "a")])
    found = ew.window_totals(frame).collect()
    assert {(r.window_start, r.event_type): (r.events, r.total) for r in found} == {
        (START, "a"): (2, Decimal("0.01")),
        (START + timedelta(hours=1), "a"): (1, Decimal("0.02")),
        (START + timedelta(hours=6), None): (1, Decimal("0.03")),
    }
    assert all(r.window_end - r.window_start == timedelta(hours=1) for r in found)


def test_late_rows_are_counted_and_change_nothing(spark):
    # Run, minute: the watermark after run 0 is 20:00 + 5 h - 2 h.
    rows = [(0, 10), (0, 300), (1, 20), (1, 170), (1, 185), (1, 700), (2, 500), (2, 30), (3, 1500)]
    frame = events(spark, [(m, 1, "a") for _, m in rows])
    run = F.element_at(F.array(*(F.lit(r) for r, _ in rows)), (F.col("event_id") + 1).cast("int"))
    stream, runs = as_runs(frame, run)
    final = ew.window_runs(stream, runs, lateness="2 hours")
    judged = ew.with_late_rows(final, frame, lateness="2 hours").collect()
    hours = {
        (r.window_start - START) // timedelta(hours=1): (r.events, r.late, r.total)
        for r in judged
    }
    # 20, 170 (its window ended at 180 minutes) come after the window had ended; 185 does not;
    # 500 and 30 come after run 1 had brought the watermark to 580 minutes.
    assert hours == {
        0: (1, 2, Decimal("0.00")),
        2: (0, 1, None),
        3: (1, 0, Decimal("0.04")),
        5: (1, 0, Decimal("0.01")),
        8: (0, 1, None),
        11: (1, 0, Decimal("0.05")),
    }
    assert sum(r.events + r.late for r in judged) == len(rows) - 1  # the last window is open


def test_stream_without_late_rows_equals_the_table(spark):
    rng = random.Random(1)
    frame = events(spark, sorted((rng.randrange(6000), 1, rng.choice("abc")) for _ in range(300)))
    stream, runs = as_runs(frame, F.floor(micros(F.col("ts")) / F.lit(1440 * 60_000_000)))
    final = Counter(tuple(r) for r in ew.window_runs(stream, runs, lateness="1 minute").collect())
    table = Counter(tuple(r) for r in ew.window_totals(frame).collect())
    assert not final - table
    left = [r[1] for r in (table - final).elements()]
    assert min(left) > START + timedelta(minutes=5900)


def brute_sessions(frame, gap):
    by_user = {}
    for r in frame.where("ts IS NOT NULL").orderBy("ts", "event_id").collect():
        by_user.setdefault(r.user_id, []).append((r.ts, Decimal(str(r.value))))
    out = Counter()
    for user, own in by_user.items():
        parts = [[own[0]]]
        for at, value in own[1:]:
            if at - parts[-1][-1][0] > timedelta(seconds=gap):
                parts.append([])
            parts[-1].append((at, value))
        for part in parts:
            out[user, part[0][0], part[-1][0], len(part), sum(v for _, v in part)] += 1
    return out


def test_sessions_of_a_table(spark, new_york):
    rng = random.Random(2)
    rows = [(0, 1, "a"), (30, 1, "a"), (60, 1, "a"), (91, 1, "a")]  # the gap itself, and more
    rows += [(5, 2, "a")] * 4 + [(None, 2, "a"), (7, None, "a"), (8, None, "a")]
    rows += [(rng.randrange(20000), rng.randrange(3, 9), "b") for _ in range(500)]
    frame = events(spark, rows)
    for gap in (1800, 60, 7200):
        assert Counter(tuple(r) for r in se.sessions(frame, gap).collect()) == brute_sessions(frame, gap)
    assert se.sessions(frame.limit(0)).count() == 0


def test_a_user_with_a_third_of_all_events_comes_as_bursts(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(3000), 1, "a") for _ in range(4000)]
    rows += [(rng.randrange(3000), rng.randrange(2, 2000), "a") for _ in range(8000)]
    frame = events(spark, rows).repartition(4)
    bursts = se._bursts(frame, 1800)
    # The hot user is a row for each stretch, whatever the number of events.
    assert bursts.where("user_id = 1").count() <= 3000 / 30 + 1
    assert Counter(tuple(r) for r in se.sessions(frame, 1800).collect()) == brute_sessions(frame, 1800)


def test_sessions_of_a_stream_go_on_over_runs(spark):
    rows = [(0, 1, "a"), (20, 1, "a"), (45, 1, "a"), (70, 1, "a"), (71, 2, "a"), (200, 3, "a")]
    rows += [(230, 3, "a"), (600, 4, "a")]
    frame = events(spark, rows)
    stream, runs = as_runs(frame, F.col("event_id"))  # a run for each event
    found = Counter(tuple(r) for r in se.session_runs(stream, runs, 1800, "1 minute").collect())
    whole = brute_sessions(frame, 1800)
    assert found == Counter({s: n for s, n in whole.items() if s[0] != 4})
    assert (1, START, START + timedelta(minutes=70), 4, Decimal("0.06")) in found


def test_stream_and_table_agree_on_final_sessions(spark):
    rng = random.Random(4)
    frame = events(spark, sorted((rng.randrange(4000), rng.randrange(12), "a") for _ in range(400)))
    stream, runs = as_runs(frame, F.floor(F.col("event_id") / 150))
    found = Counter(tuple(r) for r in se.session_runs(stream, runs, 3600, "10 minutes").collect())
    table = Counter(tuple(r) for r in se.sessions(frame, 3600).collect())
    assert found and not found - table
    mark = frame.agg(F.max("ts")).first()[0] - timedelta(minutes=10)
    assert all(r[2] + timedelta(hours=1) > mark for r in (table - found).elements())


def test_the_state_has_partitions_for_its_rows(spark, tmp_path):
    frame = events(spark, [(0, 1, "a"), (70, 2, "b"), (200, 3, None), (None, 4, "a")])
    assert ew.window_groups(frame) == 3 and ew.window_groups(frame.limit(0)) == 0
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 600)
        wanted = [state_partitions(spark, n) for n in (0, 10**5 * (cores + 5), 10**5 * 599 + 1, 10**9)]
        assert wanted == [cores, cores + 5, 600, 600]
        stream, runs = as_runs(frame, F.lit(0).cast("bigint"))
        for _ in runs:
            run_available(ew.window_totals(stream), f"{tmp_path}/sink", f"{tmp_path}/state", 3)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "600"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert {p.name for p in (tmp_path / "state/state/0").iterdir() if p.name.isdigit()} == {"0", "1", "2"}
