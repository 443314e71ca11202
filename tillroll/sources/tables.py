"""Table reads and writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Overwrite the Parquet table at ``path`` and return it as read back.

    With ``partition_by`` the rows are first brought together by these columns, and a value
    with very many rows is spread over several tasks and files.
    """
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored.select(*(f"`{name}`" for name in df.columns))


def write_report_csv(report: DataFrame, path: str) -> None:
    """One CSV file with a header. For reports, which have a row per month, country or
    top product; never for line-level tables."""
    report.coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_report_json(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    batch_rows: int = 10_000,
    connections: int = 16,
) -> None:
    """Append to a database table in batches over a limited number of connections.

    The shuffle keeps the limit to the writing: what makes the rows runs as wide as ever."""
    df.repartition(connections).write.option("batchsize", batch_rows).jdbc(
        url, table, mode="append", properties=dict(properties)
    )
