"""Micro-batches for sinks that can only append, each counted once.

A batch is appended with the name of its stream, its number and the attempt; then one row in a
ledger says that this attempt of the batch is complete. A batch that is repeated after a crash is appended again
as another attempt, and readers take one attempt of each batch that the ledger names: rows of
attempts without a ledger row, or with a later one, are never seen.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.groups import join_splittable
from tidemill.sources.folders import exists

_BATCH = ["stream", "batch_id"]
_MARKS = [*_BATCH, "attempt"]
_LEDGER = "stream string, batch_id long, attempt string"


def append_to_folder(path: str) -> Callable[[DataFrame], None]:
    """Append rows to Parquet files below ``path``, a folder for each attempt."""

    def append(rows: DataFrame) -> None:
        rows.write.mode("append").partitionBy(*_MARKS).parquet(path)

    return append


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    """One attempt of each complete batch."""
    if not exists(spark, path):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(path).groupBy(*_BATCH).agg(F.min("attempt").alias("attempt"))


def is_committed(spark: SparkSession, ledger: str, stream: str, batch_id: int) -> bool:
    named = (F.col("stream") == stream) & (F.col("batch_id") == batch_id)
    return not _ledger(spark, ledger).where(named).isEmpty()


def commit(spark: SparkSession, ledger: str, stream: str, batch_id: int, attempt: str) -> None:
    row = spark.createDataFrame([(stream, batch_id, attempt)], _LEDGER)
    row.coalesce(1).write.mode("append").parquet(ledger)


def ledger_batches(append: Callable[[DataFrame], None], ledger: str, stream: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch writer: ``append`` gets the rows with ``stream``, ``batch_id`` and ``attempt``, then the ledger a row.

    ``append`` may be an insert into any table that keeps those three columns. A batch that the
    ledger already names is not sent again. ``stream`` names the query: batch numbers start anew with another checkpoint.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if is_committed(spark, ledger, stream, batch_id):
            return
        attempt = uuid.uuid4().hex
        marks = {"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("bigint"), "attempt": F.lit(attempt)}
        append(batch.withColumns(marks))
        commit(spark, ledger, stream, batch_id, attempt)

    return write_batch


def committed_rows(staged: DataFrame, ledger: str) -> DataFrame:
    """Rows of ``staged`` that belong to a complete batch, each batch once, without the three columns."""
    spark = staged.sparkSession
    typed = staged.withColumns({"batch_id": F.col("batch_id").cast("bigint"), "attempt": F.col("attempt").cast("string")})
    return join_splittable(typed, _ledger(spark, ledger), _MARKS).drop(*_MARKS)


def abandoned_attempts(staged: DataFrame, ledger: str) -> DataFrame:
    """(stream, batch_id, attempt, rows) that no reader sees, for cleaning up between runs."""
    counts = staged.groupBy(*_MARKS).agg(F.count("*").alias("rows"))
    return counts.join(_ledger(staged.sparkSession, ledger), _MARKS, "left_anti")
