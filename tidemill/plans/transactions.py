"""Reports over transactions and their logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.groups import average, join_splittable
from tidemill.scratch import write_table

# The currencies reported by default.
CURRENCIES = ("USD", "EUR", "RUB")


def currency_totals(
    transactions: DataFrame,
    *,
    currencies: Sequence[str] = CURRENCIES,
    currency: str = "currency",
    amount: str = "amount",
) -> DataFrame:
    """Total amount in each listed currency."""
    return (
        transactions.where(F.col(currency).isin(*currencies))
        .groupBy(currency)
        .agg(F.sum(amount).alias("total_amount_in_currency"))
    )


def fraud_summary(
    transactions: DataFrame, *, flag: str = "is_fraud", amount: str = "amount"
) -> DataFrame:
    """Count, total and average per flag; NULL is a group."""
    return transactions.groupBy(flag).agg(
        F.count(F.lit(1)).alias("transactions_count"),
        F.sum(amount).alias("total_amount"),
        average(amount).alias("transactions_avg_amount"),
    )


def daily_transactions(
    transactions: DataFrame, *, time: str = "transaction_date", amount: str = "amount"
) -> DataFrame:
    """Count, total and average per calendar day."""
    return transactions.groupBy(F.to_date(time).alias("transaction_date")).agg(
        F.count(F.lit(1)).alias("transactions_count"),
        F.sum(amount).alias("total_amount"),
        average(amount).alias("avg_amount"),
    )


def logs_per_transaction(
    logs: DataFrame, transactions: DataFrame, *, transaction: str = "transaction_id"
) -> DataFrame:
    """Log rows joined to each transaction, fewest first.

    Both sides are counted before the join, so no key has more than one row in it; the
    product of the counts is the number of joined rows.
    """
    log_rows = logs.groupBy(transaction).agg(F.count(F.lit(1)).alias("log_rows"))
    transaction_rows = transactions.groupBy(transaction).agg(F.count(F.lit(1)).alias("transaction_rows"))
    return (
        log_rows.join(transaction_rows, transaction)
        .select(transaction, (F.col("log_rows") * F.col("transaction_rows")).alias("logs_count"))
        .orderBy("logs_count", transaction)
    )


def _category_pairs(
    logs: DataFrame, transactions: DataFrame, category: str, transaction: str, amount: str
) -> DataFrame:
    """Each (category, transaction) once, with the transaction's average amount."""
    averages = (
        transactions.where(F.col(transaction).isNotNull())
        .groupBy(transaction)
        .agg(F.avg(amount).alias("avg_amount"))
    )
    pairs = (
        logs.where(F.col(transaction).isNotNull())
        .select(F.col(category).alias("category_name"), transaction)
        .distinct()
    )
    return join_splittable(pairs, averages, [transaction])


def _category_amounts(
    logs: DataFrame, transactions: DataFrame, category: str, transaction: str, amount: str
) -> DataFrame:
    """Each distinct average amount in a category, with the transactions having it."""
    return (
        _category_pairs(logs, transactions, category, transaction, amount)
        .groupBy("category_name", "avg_amount")
        .agg(F.count(F.lit(1)).alias("pairs"))
    )


def category_values(
    logs: DataFrame,
    transactions: DataFrame,
    *,
    category: str = "category",
    transaction: str = "transaction_id",
    amount: str = "amount",
) -> DataFrame:
    """Distinct (category, transactions in it, average amount of one of them).

    The amounts are written because they are read twice, and their counts so that Spark can
    see whether these are small enough to broadcast.
    """
    values = write_table(_category_amounts(logs, transactions, category, transaction, amount), "values")
    counts = values.groupBy("category_name").agg(F.sum("pairs").alias("transactions_count"))
    counted = join_splittable(values, write_table(counts, "counts"), ["category_name"], null_safe=True)
    return counted.select(
        "category_name", "transactions_count", "avg_amount"
    )


def category_rollup(
    logs: DataFrame,
    transactions: DataFrame,
    *,
    category: str = "category",
    transaction: str = "transaction_id",
    amount: str = "amount",
) -> DataFrame:
    """Transactions per category, with sum and average of their *distinct* average amounts.

    Two transactions of equal amount in a category count twice but add up once; see
    ``category_rollup_exact`` for the plain total. Distinct counts are aggregates here, so
    a category holding most rows is still reduced in many tasks.
    """
    values = _category_amounts(logs, transactions, category, transaction, amount)
    return values.groupBy("category_name").agg(
        F.sum("pairs").alias("transactions_count"),
        F.sum("avg_amount").alias("total_amount"),
        average("avg_amount").alias("avg_amount"),
    )


def category_rollup_exact(
    logs: DataFrame,
    transactions: DataFrame,
    *,
    category: str = "category",
    transaction: str = "transaction_id",
    amount: str = "amount",
) -> DataFrame:
    """As ``category_rollup``, every transaction of a category adding to its total."""
    pairs = _category_pairs(logs, transactions, category, transaction, amount)
    return pairs.groupBy("category_name").agg(
        F.count(F.lit(1)).alias("transactions_count"),
        F.sum("avg_amount").alias("total_amount"),
        average("avg_amount").alias("avg_amount"),
    )
