import pytest
from pyspark.sql import functions as F
from tillroll import schemas
from tillroll.functions import scalars
from tillroll.operators import aggregates, cleaning, reports, star
from tillroll.plans.warehouse import build_star
from tillroll.sources.order_lines import order_lines
from tillroll.sources.staging import stage


@pytest.fixture(scope="module")
def cleaned(spark, sf_small):
    return stage(cleaning.clean(order_lines(spark, sf_small)), "cleaned")


@pytest.fixture(scope="module")
def tables(cleaned):
    return build_star(cleaned, stage)


def violations(tables):
    return {
        (r.check, r.table): r.violations
        for r in star.star_integrity(tables).collect()
        if r.violations
    }


def test_schemas(tables):
    for name, schema in schemas.STAR_SCHEMAS.items():
        found = [(f.name, f.dataType) for f in tables[name].schema]
        assert found == [(f.name, f.dataType) for f in schema], name


def test_sound_star(cleaned, tables):
    assert violations(tables) == {}
    counts = {r.table: r.rows for r in star.verify_load(tables).collect()}
    assert counts["fact_sales"] == cleaned.count()
    assert counts["dim_customer"] == cleaned.select("Customer ID").distinct().count()
    fact = tables["fact_sales"]
    assert fact.select("sale_id").distinct().count() == counts["fact_sales"]
    assert fact.where("date_id is null or region_id is null").count() == 0


def test_keys_join_back_to_their_values(cleaned, tables):
    back = (
        tables["fact_sales"].join(tables["dim_date"], "date_id")
        .join(tables["dim_region"], "region_id")
        .select("invoice", "full_date", "country", "quantity", "revenue")
    )
    source = cleaned.select("Invoice", "InvoiceDate", "Country", "Quantity", "Revenue")
    assert back.exceptAll(source).count() == 0 and source.exceptAll(back).count() == 0


def test_broken_rules_are_found(tables):
    fact, dates = tables["fact_sales"], tables["dim_date"]
    broken = dict(
        tables,
        dim_date=dates.where("date_id > 1"),
        dim_product=tables["dim_product"].union(tables["dim_product"].limit(1)),
        fact_sales=fact.withColumn("invoice", F.lpad("invoice", 21, "0")),
    )
    found = violations(broken)
    orphans = fact.where("date_id = 1").count()
    assert found == {
        ("foreign_key(date_id)", "fact_sales"): orphans,
        ("primary_key(stock_code)", "dim_product"): 1,
        ("width(invoice)", "fact_sales"): fact.count(),
    }


def test_null_key_matches_null(spark, cleaned):
    nobody = cleaned.withColumn("Country", F.lit(None).cast("string"))
    regions = spark.createDataFrame([(1, None)], "region_id int, country string")
    fact = star.fact_sales(nobody, star.dim_date(cleaned), regions)
    assert fact.where("region_id = 1").count() == cleaned.count()


def test_region_groups(spark):
    expected = {
        "United Kingdom": "Europe", "Iceland": "Europe", "Brazil": "Americas",
        "Bahrain": "Asia", "EIRE": "Other", "Unknown": "Other", "france": "Other",
    }
    frame = spark.createDataFrame([(c,) for c in expected], "c string")
    rows = frame.select("c", scalars.region_group(F.col("c")).alias("g")).collect()
    assert {r.c: r.g for r in rows} == expected


def test_report_totals_agree(cleaned, tables):
    fact = tables["fact_sales"]
    whole = cleaned.agg(F.sum("Revenue").alias("r")).first().r
    by_month = reports.export_monthly(fact, tables["dim_date"])
    by_country = reports.export_by_country(fact, tables["dim_region"])
    assert by_month.agg(F.sum("monthly_revenue").alias("r")).first().r == whole
    assert by_country.agg(F.sum("total_revenue").alias("r")).first().r == whole
    one = {(r.year, r.month): r.total_orders for r in by_month.collect()}
    other = {(r.Year, r.Month): r.TotalOrders for r in aggregates.monthly(cleaned).collect()}
    assert one == other


@pytest.mark.parametrize(
    "table, change, rule",
    [
        ("dim_customer", lambda t: t.unionByName(t.limit(1)), r"primary_key\(customer_id\)"),
        ("dim_region", lambda t: t.withColumn("country", F.lit("one")), r"unique\(country\)"),
        (
            "fact_sales",
            lambda t: t.withColumn("sale_id", F.lit(1).cast("bigint")),
            r"primary_key\(sale_id\)",
        ),
        (
            "fact_sales",
            lambda t: t.withColumn("date_id", F.lit(-1).cast("bigint")),
            r"foreign_key\(date_id\)",
        ),
        ("fact_sales", lambda t: t.withColumn("invoice", F.repeat(F.lit("9"), F.lit(21))), "width"),
    ],
)
def test_a_broken_rule_stops_the_load(tables, table, change, rule):
    broken = {**tables, table: change(tables[table])}
    with pytest.raises(star.LoadError, match=rule):
        star.enforce_integrity(star.star_integrity(broken))


def test_a_missing_column_is_no_table_of_the_star(tables):
    with pytest.raises(star.LoadError, match="country"):
        star.conform(tables["dim_customer"].drop("country"), "dim_customer")
