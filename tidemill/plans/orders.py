"""Reports over orders and their items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.labels import iso_day_label, start_of_day
from tidemill.operators.groups import average, join_splittable


def payment_status_summary(
    orders: DataFrame, *, status: str = "payment_status", amount: str = "total_amount"
) -> DataFrame:
    """Count, total and average of orders per payment status."""
    return orders.groupBy(status).agg(
        F.count(F.lit(1)).alias("orders_count"),
        F.sum(amount).alias("orders_total_amount"),
        average(amount).alias("orders_average_totals"),
    )


def _order_rows(orders: DataFrame, order: str) -> DataFrame:
    """How often each order id occurs: the factor a join with orders multiplies by."""
    return orders.groupBy(order).agg(F.count(F.lit(1)).alias("order_rows"))


def order_item_totals(
    orders: DataFrame,
    items: DataFrame,
    *,
    order: str = "order_id",
    quantity: str = "quantity",
    price: str = "product_price",
) -> DataFrame:
    """Number and value of the items of each order that has any.

    Both sides are aggregated per order before they meet.
    """
    totals = items.groupBy(order).agg(
        F.sum(quantity).alias("items_count"),
        F.sum(F.col(price) * F.col(quantity)).alias("total_product_price"),
    )
    rows = F.col("order_rows")
    return totals.join(_order_rows(orders, order), order).select(
        order,
        (F.col("items_count") * rows).alias("items_count"),
        (F.col("total_product_price") * rows).alias("total_product_price"),
    )


def product_sales(
    orders: DataFrame,
    items: DataFrame,
    *,
    order: str = "order_id",
    product: str = "product_name",
    quantity: str = "quantity",
    price: str = "product_price",
) -> DataFrame:
    """Quantity, average price and value sold of each product, over items with an order.

    Orders are reduced to one row per id before the join, items are summed right after it;
    sums are multiplied only when nothing but (product, factor) is left.
    """
    sold = items.where(F.col(order).isNotNull()).select(order, product, quantity, price)
    sums = (
        join_splittable(sold, _order_rows(orders, order), [order])
        .groupBy(product, "order_rows")
        .agg(
            F.sum(quantity).alias("quantity"),
            F.sum(price).alias("price"),
            F.count(price).alias("prices"),
            F.sum(F.col(price) * F.col(quantity)).alias("value"),
        )
    )
    rows = F.col("order_rows")
    return sums.groupBy(product).agg(
        F.sum(F.col("quantity") * rows).alias("total_quantity"),
        (
            F.sum(F.col("price") * rows).cast("double")
            / F.nullif(F.sum(F.col("prices") * rows), F.lit(0))
        ).alias("avg_product_price"),
        F.sum(F.col("value") * rows).alias("total_product_price"),
    )


def daily_orders(
    orders: DataFrame, *, time: str = "order_date", amount: str = "total_amount"
) -> DataFrame:
    """Count, total and average of orders per day in date order, under the day's label."""
    return (
        orders.groupBy(start_of_day(F.col(time)).alias("day_start"))
        .agg(
            F.count(F.lit(1)).alias("transactions_amount"),
            F.sum(amount).alias("orders_total_amount"),
            average(amount).alias("orders_avg_amount"),
        )
        .orderBy("day_start")
        .select(
            iso_day_label(F.col("day_start")).alias("day"),
            "transactions_amount",
            "orders_total_amount",
            "orders_avg_amount",
        )
    )


def user_order_ranking(
    orders: DataFrame, *, user: str = "user_id", amount: str = "total_amount"
) -> DataFrame:
    """Orders and spending of each user, most orders first, then most spent."""
    return (
        orders.groupBy(user)
        .agg(
            F.count(F.lit(1)).alias("orders_count"),
            F.sum(amount).alias("orders_total_amount"),
        )
        .orderBy(F.desc("orders_count"), F.desc("orders_total_amount"), user)
    )
