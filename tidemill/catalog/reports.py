"""Transaction and order reports on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.catalog import tables
from tidemill.catalog.tables import as_double
from tidemill.operators.groups import partition_average
from tidemill.operators.ranks import dense_ranks
from tidemill.plans import orders, transactions

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM")


def currency_totals(spark: SparkSession, folder: str) -> DataFrame:
    totals = transactions.currency_totals(tables.transactions(spark, folder), currencies=PRIORITIES)
    return as_double(totals, "total_amount_in_currency")


def fraud_summary(spark: SparkSession, folder: str) -> DataFrame:
    return as_double(transactions.fraud_summary(tables.transactions(spark, folder)), "total_amount")


def daily_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return as_double(transactions.daily_transactions(tables.transactions(spark, folder)), "total_amount")


def logs_per_transaction(spark: SparkSession, folder: str) -> DataFrame:
    return transactions.logs_per_transaction(
        tables.logs(spark, folder), tables.transactions(spark, folder)
    )


def category_values(spark: SparkSession, folder: str) -> DataFrame:
    values = transactions.category_values(
        tables.logs(spark, folder), tables.transactions(spark, folder)
    )
    return as_double(values, "avg_amount")


def category_rollup(spark: SparkSession, folder: str) -> DataFrame:
    rollup = transactions.category_rollup(
        tables.logs(spark, folder), tables.transactions(spark, folder)
    )
    return as_double(rollup, "total_amount")


def category_rollup_exact(spark: SparkSession, folder: str) -> DataFrame:
    rollup = transactions.category_rollup_exact(
        tables.logs(spark, folder), tables.transactions(spark, folder)
    )
    return as_double(rollup, "total_amount")


def transaction_ranks(spark: SparkSession, folder: str) -> DataFrame:
    return dense_ranks(tables.logs(spark, folder), ["category"], "transaction_id")


def transaction_averages(spark: SparkSession, folder: str) -> DataFrame:
    items = tables.order_items(spark, folder).select("order_id", "product_id", "product_price")
    return as_double(
        partition_average(items, ["order_id"], "product_price", "order_avg_price"), "product_price"
    )


def payment_status_summary(spark: SparkSession, folder: str) -> DataFrame:
    return as_double(orders.payment_status_summary(tables.orders(spark, folder)), "orders_total_amount")


def order_item_totals(spark: SparkSession, folder: str) -> DataFrame:
    totals = orders.order_item_totals(tables.orders(spark, folder), tables.order_items(spark, folder))
    return totals.withColumns(
        {
            "items_count": F.col("items_count").cast("bigint"),
            "total_product_price": F.col("total_product_price").cast("double"),
        }
    )


def product_sales(spark: SparkSession, folder: str) -> DataFrame:
    sales = orders.product_sales(tables.orders(spark, folder), tables.named_order_items(spark, folder))
    return as_double(sales, "total_product_price")


def daily_orders(spark: SparkSession, folder: str) -> DataFrame:
    return as_double(orders.daily_orders(tables.orders(spark, folder)), "orders_total_amount")


def user_order_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return as_double(orders.user_order_ranking(tables.orders(spark, folder)), "orders_total_amount")


QUERIES = {
    "currency_totals": currency_totals,
    "fraud_summary": fraud_summary,
    "daily_transactions": daily_transactions,
    "logs_per_transaction": logs_per_transaction,
    "category_values": category_values,
    "category_rollup": category_rollup,
    "category_rollup_exact": category_rollup_exact,
    "transaction_ranks": transaction_ranks,
    "transaction_averages": transaction_averages,
    "payment_status_summary": payment_status_summary,
    "order_item_totals": order_item_totals,
    "product_sales": product_sales,
    "daily_orders": daily_orders,
    "user_order_ranking": user_order_ranking,
}


def _category_values_sql(more: int = 0) -> str:
    """Per category the number of its orders, with each different amount they have."""
    return f"""
        WITH held AS (
            SELECT l_returnflag AS category_name, l_orderkey AS order_key
            FROM lineitem SEMI JOIN orders ON l_orderkey = o_orderkey
            GROUP BY l_returnflag, l_orderkey
        ), sizes AS (
            SELECT category_name, COUNT(order_key) AS transactions_count FROM held GROUP BY category_name
        ), amounts AS (
            SELECT o_orderkey AS order_key,
                   CAST(AVG(CAST(o_totalprice AS DECIMAL(12,2)) + {more}) AS DECIMAL(16,6)) AS avg_amount
            FROM orders GROUP BY o_orderkey
        )
        SELECT category_name, transactions_count, avg_amount
        FROM held JOIN sizes USING (category_name) JOIN amounts USING (order_key)
        GROUP BY category_name, transactions_count, avg_amount
    """


def category_rollup_sql(more: int = 0) -> str:
    """The category report, every amount raised by ``more``."""
    return f"""
        SELECT category_name, CAST(MAX(transactions_count) AS BIGINT) AS transactions_count,
               CAST(SUM(avg_amount) AS DOUBLE) AS total_amount,
               CAST(SUM(avg_amount) AS DOUBLE) / COUNT(avg_amount) AS avg_amount
        FROM ({_category_values_sql(more)})
        GROUP BY category_name
    """


SQL = {
    "currency_totals": """
        SELECT o_orderpriority AS currency,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_amount_in_currency
        FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
        GROUP BY o_orderpriority
    """,
    "fraud_summary": """
        SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS is_fraud,
               COUNT(*) AS transactions_count,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_amount,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / COUNT(o_totalprice)
                   AS transactions_avg_amount
        FROM orders
        GROUP BY CAST(o_orderstatus = 'F' AS INTEGER)
    """,
    "daily_transactions": """
        SELECT CAST(o_orderdate AS DATE) AS transaction_date,
               COUNT(*) AS transactions_count,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_amount,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / COUNT(o_totalprice)
                   AS avg_amount
        FROM orders
        GROUP BY CAST(o_orderdate AS DATE)
    """,
    "logs_per_transaction": """
        SELECT o.o_orderkey AS transaction_id, COUNT(*) AS logs_count
        FROM lineitem li JOIN orders o ON li.l_orderkey = o.o_orderkey
        GROUP BY o.o_orderkey
        ORDER BY logs_count, transaction_id
    """,
    "category_values": f"""
        SELECT category_name, CAST(transactions_count AS BIGINT) AS transactions_count,
               CAST(avg_amount AS DOUBLE) AS avg_amount
        FROM ({_category_values_sql()})
    """,
    "category_rollup": category_rollup_sql(),
    "category_rollup_exact": """
        SELECT category_name, COUNT(*) AS transactions_count,
               CAST(SUM(amount) AS DOUBLE) AS total_amount,
               CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_amount
        FROM (
            SELECT DISTINCT li.l_returnflag AS category_name, o.o_orderkey,
                   CAST(o.o_totalprice AS DECIMAL(12,2)) AS amount
            FROM lineitem li JOIN orders o ON li.l_orderkey = o.o_orderkey
        )
        GROUP BY category_name
    """,
    "transaction_ranks": """
        SELECT DISTINCT l_returnflag AS category, l_orderkey AS transaction_id,
               DENSE_RANK() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey) AS rank_ascending,
               DENSE_RANK() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey DESC)
                   AS rank_descending
        FROM lineitem
    """,
    "transaction_averages": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               l_extendedprice AS product_price,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2)))
                    OVER (PARTITION BY l_orderkey) AS DOUBLE)
                   / COUNT(l_extendedprice) OVER (PARTITION BY l_orderkey) AS order_avg_price
        FROM lineitem
    """,
    "payment_status_summary": """
        SELECT o_orderstatus AS payment_status, COUNT(*) AS orders_count,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS orders_total_amount,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / COUNT(o_totalprice)
                   AS orders_average_totals
        FROM orders
        GROUP BY o_orderstatus
    """,
    "order_item_totals": """
        SELECT o.o_orderkey AS order_id,
               CAST(SUM(CAST(li.l_quantity AS INTEGER)) AS BIGINT) AS items_count,
               CAST(SUM(CAST(li.l_extendedprice AS DECIMAL(12,2)) * CAST(li.l_quantity AS INTEGER))
                    AS DOUBLE) AS total_product_price
        FROM orders o JOIN lineitem li ON o.o_orderkey = li.l_orderkey
        GROUP BY o.o_orderkey
    """,
    "product_sales": """
        SELECT p.p_brand AS product_name,
               CAST(SUM(CAST(li.l_quantity AS INTEGER)) AS BIGINT) AS total_quantity,
               CAST(SUM(CAST(li.l_extendedprice AS DECIMAL(12,2))) AS DOUBLE)
                   / COUNT(li.l_extendedprice) AS avg_product_price,
               CAST(SUM(CAST(li.l_extendedprice AS DECIMAL(12,2)) * CAST(li.l_quantity AS INTEGER))
                    AS DOUBLE) AS total_product_price
        FROM orders o
        JOIN lineitem li ON o.o_orderkey = li.l_orderkey
        JOIN part p ON li.l_partkey = p.p_partkey
        GROUP BY p.p_brand
    """,
    "daily_orders": """
        SELECT strftime(date_trunc('day', o_orderdate), '%a %d %b %G') AS day,
               COUNT(*) AS transactions_amount,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS orders_total_amount,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / COUNT(o_totalprice)
                   AS orders_avg_amount
        FROM orders
        GROUP BY date_trunc('day', o_orderdate)
        ORDER BY date_trunc('day', o_orderdate)
    """,
    "user_order_ranking": """
        SELECT o_custkey AS user_id, COUNT(*) AS orders_count,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS orders_total_amount
        FROM orders
        GROUP BY o_custkey
        ORDER BY orders_count DESC, orders_total_amount DESC, user_id
    """,
}
