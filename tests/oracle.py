"""Runs a query in Spark and its SQL twin in DuckDB and compares schema and rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import types as T

KINDS = {
    T.StringType: "VARCHAR",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.DoubleType: "DOUBLE",
    T.BooleanType: "BOOLEAN",
    T.TimestampNTZType: "TIMESTAMP",
    T.DateType: "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _kind(data_type: T.DataType) -> str:
    if isinstance(data_type, T.DecimalType):
        return f"DECIMAL({data_type.precision},{data_type.scale})"
    return KINDS[type(data_type)]


def expected(connection, sql: str):
    result = connection.execute(sql)
    names = [(d[0], str(d[1])) for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i][0])
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return [names[i] for i in order], rows


def actual(df):
    names = sorted((f.name, _kind(f.dataType)) for f in df.schema)
    rows = Counter(tuple(row[name] for name, _ in names) for row in df.collect())
    return names, rows
