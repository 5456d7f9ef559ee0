"""Delimited files into typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill import schemas
from tidemill.sinks.tables import insert_into, replace_table
from tidemill.sources.files import read_delimited


def load_orders(
    spark: SparkSession, path: str, table: str, *, schema=schemas.ORDERS, sep: str = ","
) -> DataFrame:
    """Append a delimited file with a header line to an existing table."""
    insert_into(read_delimited(spark, path, schema, sep=sep, header=True), table)
    return spark.table(table)


def load_transactions(
    spark: SparkSession,
    path: str,
    table: str,
    *,
    schema=schemas.TRANSACTIONS,
    sep: str = ",",
    location: str | None = None,
) -> DataFrame:
    """Replace a table by a delimited file without header; the file stays where it is."""
    replace_table(read_delimited(spark, path, schema, sep=sep), table, location=location)
    return spark.table(table)
