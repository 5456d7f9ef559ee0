"""Catalog tables and relational databases."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def insert_into(df: DataFrame, table: str) -> None:
    """Append to a table, matching columns by name rather than by position."""
    names = df.sparkSession.table(table).columns
    df.select(*names).write.insertInto(table)


def replace_table(df: DataFrame, table: str, *, location: str | None = None) -> None:
    """Make ``df`` the content of ``table``, at ``location`` if it is kept outside the warehouse."""
    writer = df.write.mode("overwrite").format("parquet")
    if location is not None:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def switch_location(spark: SparkSession, table: str, location: str) -> None:
    """Let readers of ``table`` see the files at ``location`` from now on.

    A new version is written beside the old one and takes its place in one step, so a path
    being read is never overwritten.
    """
    escaped = location.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{escaped}'")
    spark.catalog.refreshTable(table)


def jdbc_sink_options(
    connection: Mapping[str, str], table: str, *, connections: int, batch_size: int = 10_000
) -> dict[str, str]:
    """Writer options; ``connections`` bounds the tasks writing at the same time.

    The writer narrows the rows to that many partitions without a shuffle, so the stage before
    it runs in as many tasks: write its result first where that is too few.
    """
    return {
        **connection,
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
    }


def write_jdbc(df: DataFrame, connection: Mapping[str, str], table: str, **settings) -> None:
    """Append rows to a database table."""
    options = jdbc_sink_options(connection, table, **settings)
    df.write.format("jdbc").options(**options).mode("append").save()


def jdbc_batches(
    connection: Mapping[str, str], table: str, **settings
) -> Callable[[DataFrame, int], None]:
    """Micro-batch writer for ``foreachBatch``.

    A database append may repeat after a failure, so rows carry ``batch_id``: readers keep
    one row per key, or delete a batch before it is sent again.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        write_jdbc(tagged, connection, table, **settings)

    return write_batch
