"""Reports kept up to date from the states of loads or micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.states import (
    distinct_state,
    finish_distinct,
    finish_sums,
    merge_distinct,
    merge_sums,
    sum_state,
)
from tidemill.sinks.keyed import append_load, read_loads


def add_days(transactions: DataFrame, root: str, load_id: int, *, time: str = "transaction_date", amount: str = "amount") -> None:
    """Keep a load's daily states; the same ``load_id`` again replaces them."""
    append_load(sum_state(transactions, [F.to_date(time).alias("transaction_date")], amount), root, load_id)


def daily_transactions(spark: SparkSession, root: str) -> DataFrame:
    """Count, total and average per day over all loads; no transaction is read again."""
    return finish_sums(
        read_loads(spark, root), ["transaction_date"], count="transactions_count", total="total_amount", mean="avg_amount"
    )


def add_category_transactions(
    logs: DataFrame, root: str, load_id: int, *, category: str = "category", transaction: str = "transaction_id"
) -> None:
    """Keep which transactions a load logs in each category."""
    append_load(distinct_state(logs, [F.col(category).alias("category_name")], transaction), root, load_id)


def category_transactions(spark: SparkSession, root: str) -> DataFrame:
    """Different transactions per category over all loads, however often one is logged."""
    return finish_distinct(read_loads(spark, root), ["category_name"], count="transactions_count")


def day_batches(root: str, *, time: str = "transaction_date", amount: str = "amount") -> Callable[[DataFrame, int], None]:
    """Micro-batch writer that keeps daily states; a repeated batch replaces its own."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        add_days(batch, root, batch_id, time=time, amount=amount)

    return write_batch


def fold_days(spark: SparkSession, root: str, new_root: str, load_id: int) -> None:
    """Write the states of all loads as one, for reports that have been kept over many."""
    append_load(merge_sums(read_loads(spark, root), ["transaction_date"]), new_root, load_id)


def fold_category_transactions(spark: SparkSession, root: str, new_root: str, load_id: int) -> None:
    append_load(merge_distinct(read_loads(spark, root), ["category_name"]), new_root, load_id)
