"""What the plans must and must not contain, so that they hold on large inputs."""

import re

import pytest
from pyspark.sql import functions as F
from tillroll.operators import aggregates, cleaning, profiling, reports, star
from tillroll.plans.catalog import QUERIES
from tillroll.plans.warehouse import build_star
from tillroll.sources.order_lines import order_lines
from tillroll.sources.staging import stage


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="module")
def raw(spark, sf_small):
    """Raw lines as a stored table, as the pipeline has them."""
    return stage(order_lines(spark, sf_small), "raw")


@pytest.mark.parametrize("name", list(QUERIES))
def test_what_no_plan_may_hold(spark, sf_small, name):
    text = plan(QUERIES[name](spark, sf_small), "simple")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in text, bad
    # Only sketches and what is gathered of JSON fields are objects.
    assert name == "sketch_weeks" or "ObjectHash" not in text
    assert not re.findall(r"SortAggregate\(key=\[\w", text), "sorts lines to aggregate"


def test_filters_reach_the_scan_through_the_distinct(raw):
    text = plan(cleaning.clean(raw))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    for name in ("Invoice", "StockCode"):
        assert f"IsNotNull({name})" in pushed
    assert "Not(StringStartsWith(Invoice,C))" in pushed
    assert plan(cleaning.clean(raw), "simple").count("Exchange") == 1


@pytest.mark.parametrize(
    "step, columns",
    [
        (profiling.profile_quantity, {"Quantity"}),
        (profiling.profile_price, {"Price"}),
        (profiling.profile_cancellations, {"Invoice"}),
        (profiling.top_countries, {"Country"}),
    ],
)
def test_only_needed_columns_are_read(raw, step, columns):
    for schema in re.findall(r"ReadSchema: struct<(.*)>", plan(step(raw))):
        assert {field.split(":")[0] for field in schema.split(",")} == columns


def executed_scans(df):
    """File scans in the plans that ran, in subqueries too; a reused exchange shows none."""
    scans, skip_from = 0, None
    for line in plan(df, "simple").splitlines():
        depth = len(line) - len(line.lstrip(" :|+-"))
        if skip_from is not None and depth >= skip_from:
            continue
        skip_from = depth if "== Initial Plan ==" in line else None
        scans += "FileScan" in line
    return scans


@pytest.mark.parametrize(
    "step",
    [
        profiling.profile_quantity,
        profiling.profile_price,
        lambda raw: star.dim_date(cleaning.clean(raw)),
        lambda raw: cleaning.step_counts(cleaning.distinct_lines(raw)),
        profiling.ingest_summary,
    ],
)
def test_lines_are_read_once(raw, step):
    df = step(raw)
    df.collect()
    assert executed_scans(df) == 1


def test_top_products_sort_only_what_they_keep(raw):
    text = plan(aggregates.top_products(cleaning.clean(raw)), "simple")
    assert "TakeOrderedAndProject" in text


def test_rank_does_not_sort_a_country_in_one_task(raw):
    text = plan(aggregates.rank_products(cleaning.clean(raw)), "simple")
    [ranked] = re.findall(r"Window \[rank\(.*?\], \[(.*?)\]", text)
    assert "_band" in ranked and "Country" in ranked
    assert "BroadcastHashJoin" in text and "SinglePartition" not in text


def test_a_moment_with_a_third_of_all_sales_is_split(spark, raw):
    cleaned = stage(
        cleaning.clean(raw).withColumn(
            "InvoiceDate",
            F.when(F.hash("Invoice", "StockCode") % 3 == 0, F.lit("2010-01-01 00:00:00"))
            .otherwise(F.col("InvoiceDate").cast("string"))
            .cast("timestamp_ntz"),
        ).repartition(16),
        "skewed",
    )
    dates = stage(star.dim_date(cleaned), "dim_date")
    regions = stage(star.dim_region(cleaned), "dim_region")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        fact = star.fact_sales(cleaned, dates, regions)
        rows = fact.collect()
        text = plan(fact, "simple")
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "SortMergeJoin(skew=true)" in text
    assert len(rows) == cleaned.count()


def test_small_dimension_is_broadcast_and_large_one_is_not(spark, raw):
    tables = build_star(stage(cleaning.clean(raw), "cleaned"), stage)
    small = plan(reports.export_by_country(tables["fact_sales"], tables["dim_region"]), "simple")
    assert "BroadcastHashJoin" in small
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
        large = plan(star.fact_sales(stage(cleaning.clean(raw), "c"), tables["dim_date"],
                                     tables["dim_region"]), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in large and "BroadcastHashJoin" not in large


def test_one_customer_with_a_third_of_all_lines(raw):
    """Guests: pairs are made distinct in each task before anything is shuffled."""
    cleaned = cleaning.clean(raw)
    skewed = cleaned.withColumn(
        "Customer ID", F.when(F.col("Quantity") % 3 == 0, 0).otherwise(F.col("Customer ID"))
    )
    dim = star.dim_customer(skewed)
    aggregates_below = [
        re.sub(r"#\d+L?", "", line)
        for line in plan(dim, "simple").splitlines()
        if "HashAggregate" in line
    ]
    assert "keys=[customer_id, country]" in aggregates_below[-2]
    guest = dim.where("customer_id = 0").collect()
    assert len(guest) == 1
    smallest = skewed.where("`Customer ID` = 0").agg(F.min("Country").alias("c")).first()
    assert guest[0].country == smallest.c


@pytest.mark.parametrize(
    "name, absent",
    [
        ("export_top_products", ["full_date", "_region", "region_group"]),
        ("export_monthly", ["_region", "region_group"]),
        ("export_by_country", ["full_date"]),
    ],
)
def test_reports_join_only_what_they_read(spark, sf_small, name, absent):
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    spark.sparkContext.setJobGroup("building", "building")
    query = QUERIES[name](spark, sf_small)
    # Nothing runs before the result is asked for, but that regions are dealt out to be numbered.
    assert name == "export_by_country" or not jobs("building")
    spark.sparkContext.setJobGroup("other", "other")
    plan = query._jdf.queryExecution().optimizedPlan().toString()
    assert not [column for column in absent if column in plan]
