import json
from pathlib import Path

import pytest
from tillroll import session
from tillroll.operators import quality
from tillroll.plans import pipeline
from tillroll.sources import staging, tables
from tillroll.sources.order_lines import order_lines


@pytest.fixture(scope="module")
def source(spark, sf_small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("in") / "lines")
    order_lines(spark, sf_small).write.csv(
        path, header=True, escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return path


@pytest.fixture(scope="module")
def out(spark, source, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("out"))
    pipeline.run(spark, source, folder)
    pipeline.run(spark, source, folder, partition_by=["Year", "Month"])
    return folder


def csv_files(folder):
    return list(Path(folder).glob("*.csv"))


def test_tables_and_counts(spark, out, sf_small):
    raw = spark.read.parquet(f"{out}/retail_raw")
    assert raw.count() == order_lines(spark, sf_small).count()
    cleaned = spark.read.parquet(f"{out}/retail_cleaned")
    fact = spark.read.parquet(f"{out}/warehouse/fact_sales")
    assert fact.count() == cleaned.count() > 0
    assert spark.read.parquet(f"{out}/agg_monthly").count() == 80
    assert spark.read.parquet(f"{out}/agg_top_products").count() == 20
    counts = spark.read.csv(f"{out}/load_counts", header=True).collect()
    assert {r["table"]: int(r["rows"]) for r in counts}["fact_sales"] == fact.count()


def test_cleaned_is_partitioned_when_asked(out):
    assert list(Path(out, "retail_cleaned").glob("Year=*/Month=*"))


@pytest.mark.parametrize("name", ["dash_monthly", "dash_top_products", "dash_by_country"])
def test_reports_are_one_csv_with_header(spark, out, name):
    (file,) = csv_files(f"{out}/{name}")
    header = file.read_text().splitlines()[0].split(",")
    key = {"dash_monthly": "month_year", "dash_top_products": "stock_code",
           "dash_by_country": "region_group"}[name]
    assert key in header
    rows = spark.read.csv(str(file), header=True).collect()
    assert rows
    if name == "dash_monthly":
        months = [row.month_year for row in rows]
        assert months == sorted(months)
    else:
        revenue = [float(row.total_revenue) for row in rows]
        assert revenue == sorted(revenue, reverse=True)


def test_profile_report(out):
    (file,) = Path(out, "data_profile_report").glob("*.json")
    report = json.loads(file.read_text())
    assert set(report) == {
        "profiled_at", "shape", "nulls", "cancellations", "quantity", "price", "scope",
        "top_countries",
    }
    assert report["shape"]["total_columns"] == 8 and len(report["nulls"]) == 8
    assert [c["rank"] for c in report["top_countries"]] == [1, 2, 3, 4, 5]
    assert report["quantity"]["p99"] > report["quantity"]["median"]


def test_failed_validation_stops_before_the_load(spark, source, tmp_path):
    folder = str(tmp_path)
    cleaned = pipeline.transform(pipeline.ingest(spark, source, folder), folder)
    strict = [quality.Expectation(quality.BETWEEN, "Quantity", 1, 2)]
    with pytest.raises(quality.QualityGateError, match="Quantity"):
        pipeline.validate(cleaned, folder, strict)
    assert spark.read.parquet(f"{folder}/expectations").where("not success").count() == 1
    assert not Path(folder, "warehouse").exists()


def test_partitioned_table_keeps_its_columns(spark, tmp_path):
    frame = spark.range(100).selectExpr("id % 3 AS part", "id AS value")
    stored = tables.write_table(frame, str(tmp_path / "t"), ["part"])
    assert stored.columns == frame.columns
    assert stored.exceptAll(frame).count() == 0 and stored.count() == 100


def test_staging_uses_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert staging.new_folder(spark, "x").startswith(named)


def test_shuffle_partitions_grow_with_the_input():
    assert session.shuffle_partitions(0, 8) == 16
    assert session.shuffle_partitions(2**40, 400) == 2**13
    # At 100 TB the pairs of map and reduce tasks stay countable for the driver.
    partitions = session.shuffle_partitions(100 * 2**40, 4000)
    splits = 100 * 2**40 / session.split_bytes(100 * 2**40)
    assert partitions * splits <= 2 * 10**9
    assert session.split_bytes(2**30) == 128 * 2**20
