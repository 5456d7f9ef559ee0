"""Whole-result comparison of a Spark query and its SQL in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return sorted(zip(*columns), key=repr)


def same_rows(spark_df, sql: str, connection: duckdb.DuckDBPyConnection) -> int:
    """Assert equal column names, types and rows in any order; return the row count."""
    result = spark_df.toArrow()
    expected = connection.sql(sql).to_arrow_table()
    assert sorted(result.column_names) == sorted(expected.column_names)
    for name in result.column_names:
        ours, theirs = result.schema.field(name).type, expected.schema.field(name).type
        assert _kind(ours) == _kind(theirs), f"{name}: {ours} and {theirs}"
    ours, theirs = _rows(result), _rows(expected)
    assert len(ours) == len(theirs)
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    assert not different, f"{len(different)} rows differ, first: {different[0]}"
    return len(ours)


def _kind(kind: pa.DataType) -> str:
    text = str(kind)
    return text.removeprefix("large_").replace("string_view", "string")
