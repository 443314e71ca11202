from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tillroll import schemas
from tillroll.functions import scalars
from tillroll.operators import aggregates, cleaning, profiling
from tillroll.sources.order_lines import order_lines

RAW = T.StructType([T.StructField(n, T.StringType()) for n in schemas.RAW_COLUMNS])
GOOD = ("1", "A", "tea pot", "2", "2010-01-02 08:30:00", "2.50", "7.0", "France")


def line(**changes):
    values = dict(zip(schemas.RAW_COLUMNS, GOOD))
    values.update({name.replace("_", " "): value for name, value in changes.items()})
    return tuple(values.values())


def frame(spark, *lines):
    return spark.createDataFrame(list(lines), RAW)


def test_one_line(spark):
    row = cleaning.clean(frame(spark, line(Description=" tea pot\t "))).first()
    assert row.Quantity == 2 and row.Price == 2.5 and row["Customer ID"] == 7
    assert row.InvoiceDate == datetime(2010, 1, 2, 8, 30)
    assert row.Revenue == Decimal("5.00")
    assert (row.Year, row.Month, row.Day, row.Hour, row.Weekday) == (2010, 1, 2, 8, 7)
    assert row.Description == "TEA POT\t"


def test_missing_values_are_filled(spark):
    lines = line(Description=None, Customer_ID=None, Country=None)
    row = cleaning.clean(frame(spark, lines)).first()
    assert row.Description == "UNKNOWN"
    assert row.Country == "Unknown"
    assert row["Customer ID"] == 0


@pytest.mark.parametrize("name", schemas.CRITICAL_COLUMNS)
def test_line_without_a_critical_value_goes(spark, name):
    assert cleaning.clean(frame(spark, line(**{name: None}))).count() == 0


@pytest.mark.parametrize(
    "changes",
    [
        {"Invoice": "C1"},
        {"Quantity": "0"},
        {"Quantity": "-3"},
        {"Quantity": "x10"},
        {"Quantity": "99999999999999999999"},
        {"Quantity": "10F"},
        {"Price": "0x1p3"},
        {"Price": "7f"},
        {"Price": "0.009"},
        {"Price": "NaN"},
        {"Price": "cheap"},
        {"InvoiceDate": "2010"},
        {"InvoiceDate": "2010-01-02"},
        {"InvoiceDate": "2010-02-30 08:00:00"},
        {"InvoiceDate": "2010-01-02 08:30:00.5"},
    ],
)
def test_bad_line_goes(spark, changes):
    assert cleaning.clean(frame(spark, line(**changes))).count() == 0


@pytest.mark.parametrize(
    "changes", [{"Invoice": "c1"}, {"Price": "0.01"}, {"InvoiceDate": "2010-01-02 8:30:00"}]
)
def test_odd_but_good_line_stays(spark, changes):
    assert cleaning.clean(frame(spark, line(**changes))).count() == 1


def test_duplicates_count_by_value(spark):
    twice = frame(spark, line(Price="2.50"), line(Price="2.5"), line(Country=None),
                  line(Country=None))
    assert cleaning.clean(twice).count() == 2
    steps = {r.step: (r.rows_in, r.rows_out) for r in cleaning.step_counts(cleaning.distinct_lines(twice)).collect()}
    assert steps["remove_duplicates"] == (4, 2)


@pytest.mark.parametrize(
    "quantity, price, revenue",
    [(3, 0.335, "1.01"), (1, 1.005, "1.01"), (1, 2.675, "2.68"), (-1, 1.005, "-1.01"),
     (7, 0.1, "0.70"), (1, 0.004, "0.00")],
)
def test_revenue_rounds_half_up(spark, quantity, price, revenue):
    row = spark.createDataFrame([(quantity, price)], "q int, p double").select(
        scalars.line_revenue(F.col("q"), F.col("p")).alias("r")
    ).first()
    assert row.r == Decimal(revenue)


def test_large_revenue_is_exact(spark):
    rows = [(2**31 - 1, 1e9), (2_000_000_000, 60_000.0), (3_000_000_000, 0.01)]
    found = spark.createDataFrame(rows, "q bigint, p double").select(
        scalars.line_revenue(F.col("q"), F.col("p")).alias("r")
    )
    assert [r.r for r in found.collect()] == [
        Decimal("2147483647000000000.00"), Decimal("120000000000000.00"), Decimal("30000000.00")
    ]


def test_revenue_is_rounded_once(spark):
    rows = [(1, 1.00499996), (1, 2.67499995), (100, 0.0000499), (1, 2.675), (3, 0.335)]
    found = spark.createDataFrame(rows, "q bigint, p double").select(
        scalars.line_revenue(F.col("q"), F.col("p")).alias("r")
    )
    assert [str(r.r) for r in found.collect()] == ["1.00", "2.67", "0.00", "2.68", "1.01"]


def test_large_ids_stay_apart(spark):
    ids = ["2147483648.0", "3000000000.0", "9007199254740993", "12d", "", None]
    found = spark.createDataFrame([(i,) for i in ids], "i string").select(
        scalars.to_integer(F.col("i")).alias("i")
    )
    assert [r.i for r in found.collect()] == [2**31, 3 * 10**9, 2**53 + 1, None, None, None]


def test_too_large_quantity_is_kept_for_the_check(spark):
    kept = cleaning.clean(frame(spark, line(Quantity="3000000000"))).first()
    assert kept.Quantity == 3_000_000_000 and kept.Revenue == Decimal("7500000000.00")


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_no_session_setting_changes_the_result(spark, zone, ansi):
    skipped_hour = "2010-03-14 02:30:00"
    before = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone",
                                             "spark.sql.ansi.enabled")}
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        lines = frame(spark, line(InvoiceDate=skipped_hour), line(Quantity="x"))
        rows = cleaning.clean(lines).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert [(r.InvoiceDate, r.Hour) for r in rows] == [(datetime(2010, 3, 14, 2, 30), 2)]


def test_cleaning_again_changes_nothing(spark, sf_small):
    cleaned = cleaning.clean(order_lines(spark, sf_small))
    again = (
        cleaned.select(*(f"`{n}`" for n in schemas.RAW_COLUMNS))
        .transform(cleaning.remove_duplicates)
        .transform(cleaning.drop_incomplete)
        .transform(cleaning.fill_defaults)
        .transform(cleaning.keep_sales)
        .transform(cleaning.add_derived)
    )
    # Trimming can make two lines equal, so compare the distinct ones.
    assert again.exceptAll(cleaned.distinct()).count() == 0
    assert cleaned.distinct().exceptAll(again).count() == 0


def test_steps_only_remove(spark, sf_small):
    raw = order_lines(spark, sf_small)
    steps = cleaning.step_counts(cleaning.distinct_lines(raw)).collect()
    for one, following in zip(steps, steps[1:]):
        assert one.rows_in >= one.rows_out == following.rows_in
    assert steps[0].rows_in == raw.count()
    assert steps[-1].rows_out == cleaning.clean(raw).count()


def test_totals_agree(spark, sf_small):
    cleaned = cleaning.clean(order_lines(spark, sf_small))
    whole = cleaned.agg(F.sum("Revenue").alias("r")).first().r
    for report, column in (
        (aggregates.monthly(cleaned), "MonthlyRevenue"),
        (aggregates.by_country(cleaned), "TotalRevenue"),
        (aggregates.rank_products(cleaned), "TotalRevenue"),
    ):
        assert report.agg(F.sum(column).alias("r")).first().r == whole


def test_reports_are_sorted(spark, sf_small):
    cleaned = cleaning.clean(order_lines(spark, sf_small))
    months = [(r.Year, r.Month) for r in aggregates.monthly(cleaned).collect()]
    assert months == sorted(months)
    for report in (aggregates.by_country(cleaned), aggregates.top_products(cleaned)):
        revenue = [r.TotalRevenue for r in report.collect()]
        assert revenue == sorted(revenue, reverse=True)


def test_profile_of_hand_made_lines(spark):
    raw = frame(spark, line(), line(), line(Invoice="C2", Quantity="-1"),
                line(Quantity="x10", Price="0", Country=None, InvoiceDate="bad"),
                line(Price="0.009", Quantity="10"))
    shape = profiling.profile_shape(raw).first()
    assert (shape.total_rows, shape.duplicate_rows, shape.duplicate_pct) == (5, 1, 20.0)
    quantity = profiling.profile_quantity(raw).first()
    assert (quantity["min"], quantity["max"], quantity["mean"]) == (-1.0, 10.0, 3.25)
    assert (quantity.median, quantity.negative, quantity.zero) == (2.0, 1, 0)
    price = profiling.profile_price(raw).first()
    assert (price.zero_or_neg, price.below_001) == (1, 2)
    cancelled = profiling.profile_cancellations(raw).first()
    assert (cancelled.cancelled_invoices, cancelled.cancellation_rate) == (1, 20.0)
    summary = profiling.ingest_summary(raw).first()
    assert (summary.null_values, summary.duplicate_rows, summary.date_max) == (1, 1, "bad")
    present = {r.column: r.present for r in profiling.required_columns(
        raw.drop("Country")).collect()}
    assert not present["Country"] and present["Invoice"] and len(present) == 8


def test_dates_in_several_layouts(spark):
    texts = {
        "2010-03-04 5:06:07": datetime(2010, 3, 4, 5, 6, 7),
        "2010-03-04T05:06:07": datetime(2010, 3, 4, 5, 6, 7),
        "2010-03-04 05:06": datetime(2010, 3, 4, 5, 6),
        "2010-03-04": datetime(2010, 3, 4),
        "4/3/2010 5:06": datetime(2010, 3, 4, 5, 6),
        "25/3/2010 5:06": datetime(2010, 3, 25, 5, 6),
        "3/25/2010 5:06": datetime(2010, 3, 25, 5, 6),
        "04.03.2010 15:06": datetime(2010, 3, 4, 15, 6),
        "31/2/2010 5:06": None, "2010": None, "tomorrow": None, "": None, None: None,
    }
    schema = ", ".join(f"`{c}` string" for c in schemas.RAW_COLUMNS)
    lines = spark.createDataFrame([("1", "1", "d", "1", t, "1", "1", "c") for t in texts], schema)
    layouts = (
        scalars.ISO, scalars.ISO_T, scalars.ISO_MINUTES, scalars.ISO_DATE,
        scalars.DAY_FIRST, scalars.MONTH_FIRST,
    )
    found = [r.InvoiceDate for r in cleaning.fix_types(lines, layouts).collect()]
    assert found == list(texts.values())
    strict = [r.InvoiceDate for r in cleaning.fix_types(lines).collect()]
    assert strict == [list(texts.values())[0]] + [None] * (len(texts) - 1)
    scope = profiling.profile_scope(lines, layouts).first()
    assert scope.unreadable_dates == 4 and scope.date_max == datetime(2010, 3, 25, 5, 6)
    assert profiling.profile_scope(lines).first().unreadable_dates == len(texts) - 2
    assert cleaning.clean(lines, layouts).count() == 5  # three moments are written twice
