from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from tillroll.operators import quality

SCHEMA = (
    "Invoice string, StockCode string, Description string, Quantity int, "
    "InvoiceDate timestamp_ntz, Price double, `Customer ID` int, Country string, "
    "Revenue decimal(18,2)"
)
COLUMNS = [check.column for check in quality.RETAIL_SUITE if check.kind == quality.EXISTS]
CRITICAL = [check.column for check in quality.RETAIL_SUITE if check.kind == quality.NOT_NULL]


@pytest.fixture(scope="module")
def good(spark):
    when = datetime(2010, 1, 2, 8, 30)
    rows = [
        ("1", "A", "TEA", 1, when, 0.01, 7, "France", Decimal("0.01")),
        ("2", "B", "POT", 100_000, when, 0.5, 0, "Spain", Decimal("50000.00")),
        ("3", "B", "POT", 2, when, 50_000.0, 0, "Spain", Decimal("100000.00")),
        ("4", "C", "BAG", 1, when, 0.01, 7, "France", Decimal("0.00")),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def failed(df):
    rows = quality.expectations(df).collect()
    assert len(rows) == 18
    return {(row.expectation, row.column) for row in rows if not row.success}


def test_bounds_are_inclusive(good):
    assert failed(good) == set()
    summary = quality.validation_summary(quality.expectations(good)).first()
    assert (summary.evaluated, summary.successful, summary.all_passed) == (18, 18, True)


@pytest.mark.parametrize("name", COLUMNS)
def test_missing_column(good, name):
    broken = failed(good.drop(name))
    about_it = {(c.kind, c.column) for c in quality.RETAIL_SUITE if c.column == name}
    assert broken == about_it


@pytest.mark.parametrize("name", CRITICAL)
def test_null_value(good, name):
    bad = good.withColumn(
        name, F.when(F.col("Invoice") != "2", F.col(name)).cast(good.schema[name].dataType)
    )
    assert failed(bad) == {(quality.NOT_NULL, name)}


@pytest.mark.parametrize(
    "name, value",
    [("Quantity", "0"), ("Quantity", "100001"), ("Price", "0.009"), ("Price", "50000.01"),
     ("Revenue", "-0.01")],
)
def test_value_out_of_bounds(good, name, value):
    bad = good.withColumn(
        name,
        F.when(F.col("Invoice") == "2", F.lit(value).cast(good.schema[name].dataType))
        .otherwise(F.col(name)),
    )
    assert failed(bad) == {(quality.BETWEEN, name)}
    row = quality.expectations(bad).where(f"column = '{name}' and not success").first()
    assert (row.element_count, row.unexpected_count) == (4, 1)


def test_not_a_number_counts_as_null(good):
    bad = good.withColumn(
        "Price", F.when(F.col("Invoice") == "2", float("nan")).otherwise(F.col("Price"))
    )
    assert failed(bad) == {(quality.NOT_NULL, "Price")}


def test_too_many_countries(spark, good):
    many = good.limit(1).join(spark.range(201).withColumnRenamed("id", "i"))
    many = many.withColumn("Country", F.concat(F.lit("c"), F.col("i").cast("string")))
    assert failed(many.where("i < 200")) == set()
    assert failed(many) == {(quality.DISTINCT_BETWEEN, "Country")}


def test_no_rows(good):
    assert failed(good.limit(0)) == {(quality.DISTINCT_BETWEEN, "Country")}


def test_revenue_tolerance(good):
    def mismatches(change):
        bad = good.withColumn("Revenue", F.col("Revenue") + F.lit(Decimal(change)))
        return quality.revenue_integrity(bad).first()

    # The last line is a penny off already.
    assert mismatches("0.00").passed
    assert mismatches("0.01").mismatches == 0
    assert mismatches("0.02").mismatches == 3 and not mismatches("0.02").passed


def test_revenue_of_a_price_too_large_to_check(good):
    large = good.withColumn("Price", F.lit(1e10))
    assert quality.revenue_integrity(large).first().mismatches == good.count()
    nothing = good.withColumn("Price", F.lit(None).cast("double"))
    assert quality.revenue_integrity(nothing.withColumn("Revenue", F.lit(None).cast("decimal(18,2)"))).first().passed


def test_gate(good):
    def enforce(df):
        quality.enforce(quality.expectations(df), quality.revenue_integrity(df))

    enforce(good)
    with pytest.raises(quality.QualityGateError, match="values_between.Quantity"):
        enforce(good.withColumn("Quantity", F.lit(0)))
    with pytest.raises(quality.QualityGateError, match="revenue_integrity"):
        enforce(good.withColumn("Revenue", F.lit(Decimal("9.99"))))


def test_precheck(good):
    worse = good.withColumn("Country", F.lit(None).cast("string"))
    row = quality.precheck(worse).first()
    assert (row.total_rows, row.null_values, row.zero_revenue) == (4, 4, 1)
