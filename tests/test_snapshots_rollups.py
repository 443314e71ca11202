"""Two loads compared, and sales at several levels, against plain loops."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from tillroll.operators import rollups, snapshots
from tillroll.plans.catalog import QUERIES

SCHEMA = "k int, j string, v double, w string"


def plan_text(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def loads(seed):
    rng = random.Random(seed)
    pick = lambda *choices: rng.choice(choices)
    before = [(pick(1, 2, 3, None), pick("a", "b", None), pick(1.0, 2.0, None), pick("x", None)) for _ in range(40)]
    after = [r for r in before if rng.random() < 0.7]
    after += [(r[0], r[1], pick(1.0, 9.0, None), r[3]) for r in before if rng.random() < 0.2]
    after += [(pick(7, None), "new", 1.0, None) for _ in range(3)]
    return before, after


@pytest.mark.parametrize("seed", range(4))
def test_changes_by_key(spark, seed):
    before, after = loads(seed)
    found = snapshots.changes_by_key(
        spark.createDataFrame(before, SCHEMA), spark.createDataFrame(after, SCHEMA), ["k", "j"]
    )
    got = {(r.k, r.j): (r.status, r.rows_before, r.rows_after, r.changed_columns) for r in found.collect()}
    groups = [defaultdict(Counter), defaultdict(Counter)]
    for group, rows in zip(groups, (before, after), strict=True):
        for k, j, *values in rows:
            group[k, j][tuple(values)] += 1
    want = {}
    for key in {*groups[0], *groups[1]}:
        b, a = groups[0].get(key, Counter()), groups[1].get(key, Counter())
        if b != a:
            status = "added" if not b else "removed" if not a else "changed"
            names = None
            if b.total() == a.total() == 1:
                names = [c for c, x, y in zip("vw", *b, *a, strict=True) if x != y]
            want[key] = (status, b.total(), a.total(), names)
    assert got == want


def test_where_nulls_are_is_told_apart(spark):
    schema = "k int, a string, b string"
    before = spark.createDataFrame([(1, "x", None), (2, None, None), (None, "n", "n")], schema)
    after = spark.createDataFrame([(1, None, "x"), (2, None, None), (None, "n", "n")], schema)
    rows = snapshots.changes_by_key(before, after, ["k"]).collect()
    assert [(r.k, r.changed_columns) for r in rows] == [(1, ["a", "b"])]


def test_join_moves_nothing_that_the_aggregates_have_dealt_out(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = spark.createDataFrame(loads(1)[0], SCHEMA)
        changes = snapshots.changes_by_key(frame, frame.limit(10), ["k", "j"])
        text = changes._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "FullOuter" in text
    # One exchange for each side; another is that of the limit.
    assert text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("seed", range(3))
def test_changes_by_row_and_summary(spark, seed):
    before, after = loads(seed)
    rows = snapshots.changes_by_row(
        spark.createDataFrame(before, SCHEMA), spark.createDataFrame(after, SCHEMA)
    )
    b, a = Counter(before), Counter(after)
    want = {r: (b[r], a[r]) for r in {*b, *a}}
    assert {tuple(r)[:4]: tuple(r)[4:] for r in rows.collect()} == want
    got = {r.status: (r.rows, r.different) for r in snapshots.change_summary(rows).collect()}
    repeated = Counter({r: n - 1 for r, n in a.items() if n > 1})
    assert got == {
        name: (c.total(), len([n for n in c.values() if n]))
        for name, c in (("added", a - b), ("removed", b - a), ("kept", a & b), ("repeated", repeated))
    }


def test_empty_loads(spark):
    frame = spark.createDataFrame(loads(0)[0], SCHEMA)
    none = frame.limit(0)
    assert {r.status for r in snapshots.changes_by_key(none, frame, ["k"]).collect()} == {"added"}
    assert {r.status for r in snapshots.changes_by_key(frame, none, ["k"]).collect()} == {"removed"}
    assert snapshots.changes_by_key(none, none, ["k"]).count() == 0
    assert snapshots.changes_by_row(none, none).count() == 0


LINES = "Invoice string, `Customer ID` bigint, Revenue decimal(31,2), Country string, Year int, Month int"


def test_levels_with_nulls_in_the_data(spark):
    rng = random.Random(1)
    rows = [
        (f"i{rng.randrange(30)}", rng.randrange(6), Decimal(rng.randrange(1, 999)) / 100,
         rng.choice(["A", "B", None]), rng.choice([2000, 2001]), rng.choice([1, 2, None]))
        for _ in range(200)
    ]
    keys = ("Country", "Year", "Month")
    sets = [*rollups.cube_sets(keys), ("Month",)]
    found = rollups.sales_by_sets(spark.createDataFrame(rows, LINES), keys, sets[:-1]).collect()
    want = {}
    for chosen in sets:
        groups = defaultdict(list)
        for r in rows:
            cell = dict(zip(keys, r[3:], strict=True))
            groups[tuple(cell[k] if k in chosen else None for k in keys)].append(r)
        level = sum(4 >> i for i, k in enumerate(keys) if k not in chosen)
        for cell, own in groups.items():
            want[(*cell, level)] = (
                sum(r[2] for r in own), len({r[0] for r in own}), len({r[1] for r in own})
            )
    assert {tuple(r)[:4]: tuple(r)[4:] for r in found} == want


def test_sets_of_rollup_and_cube():
    assert rollups.rollup_sets("ab") == [("a", "b"), ("a",), ()]
    assert rollups.cube_sets("ab") == [("a", "b"), ("a",), ("b",), ()]


def test_lines_are_shuffled_once(spark):
    lines = spark.createDataFrame([("i", 1, Decimal(1), "A", 2000, 1)], LINES)
    text = rollups.sales_by_sets(lines, ("Country", "Year"), rollups.rollup_sets(("Country", "Year")))
    plan = text._jdf.queryExecution().executedPlan().toString()
    # Both expansions stand on rows per order, which the first exchange has made.
    by_order = 'hashpartitioning(Country'
    assert plan.count("Expand") == 2 and by_order in plan


WIDE = "k int, n bigint, f double, d decimal(18,2), r decimal(38,2), t timestamp_ntz, b boolean, w string"


def wide_rows(count):
    moment = datetime(2024, 1, 1)
    return [
        (i, i * 7, i / 3, Decimal(i), Decimal(i), moment + timedelta(i), i % 2 == 0, "a long text " * 9)
        for i in range(count)
    ]


def test_columns_of_every_type_are_compared(spark):
    before = wide_rows(12)
    before[10] = (10, 1, float("nan"), None, None, None, None, None)
    before[11] = (11, 1, 0.0, None, None, None, None, None)
    after = list(before)
    names = "nfdrtbw"
    for i, change in enumerate((-1, None, Decimal("0.01"), None, datetime(1900, 1, 1), None, "x")):
        after[i] = (*before[i][: i + 1], change, *before[i][i + 2 :])
    after[7] = (7, None, None, *before[7][3:])
    after[11] = (11, 1, -0.0, *before[11][3:])  # equal to 0.0, as NaN is to itself
    frames = [spark.createDataFrame(rows, WIDE) for rows in (before, after)]
    found = snapshots.changes_by_key(*frames, ["k"]).collect()
    assert {r.k: r.changed_columns for r in found} == {
        **{i: [name] for i, name in enumerate(names)}, 7: ["n", "f"],
    }


def test_rows_told_by_digests_move_no_columns(spark):
    before = wide_rows(30) + wide_rows(3) + [(None, None, None, None, None, None, None, None)] * 2
    after = wide_rows(20) * 2 + [(None, None, None, None, None, None, None, "x")] + before[-1:]
    frames = [spark.createDataFrame(rows, WIDE) for rows in (before, after)]
    exact, told = (snapshots.changes_by_row(*frames, digests=d) for d in (False, True))
    assert told.columns == ["digest_1", "digest_2", "rows_before", "rows_after"]
    summaries = [sorted(map(tuple, snapshots.change_summary(x).collect())) for x in (exact, told)]
    assert summaries[0] == summaries[1]
    counts = [Counter((r.rows_before, r.rows_after) for r in x.collect()) for x in (exact, told)]
    assert counts[0] == counts[1]


def test_short_values_are_sent_as_they_are(spark):
    frame = spark.createDataFrame(wide_rows(3), WIDE)
    changes = plan_text(snapshots.changes_by_key(frame, frame, ["k"]))
    assert "max(n" in changes and "max(t" in changes and "bit_xor(xxhash64(isnull(w" in changes
    assert "decimal(38,0)" not in changes


def test_the_summary_sends_digests_alone(spark, sf_small):
    summary = plan_text(QUERIES["load_change_summary"](spark, sf_small))
    assert "hashpartitioning(digest_1" in summary and "hashpartitioning(Description" not in summary
