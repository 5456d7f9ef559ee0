"""Transaction and order reports on small tables with the awkward rows."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.operators.groups import partition_average
from tidemill.operators.ranks import dense_ranks
from tidemill.plans import orders, transactions


def at(text):
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.fixture(scope="module")
def deals(spark):
    return spark.createDataFrame(
        [
            (1, 10, 10.0, "USD", at("2024-01-01 23:59:00"), 0),
            (2, 10, 10.0, "EUR", at("2024-01-02 00:00:00"), 1),
            (3, 11, 5.0, "GBP", at("2024-01-02 12:00:00"), None),
            (4, 11, 2.5, None, at("2024-01-02 13:00:00"), 0),
            (5, 12, None, "USD", None, 1),
        ],
        schemas.TRANSACTIONS,
    )


@pytest.fixture(scope="module")
def notes(spark):
    at_noon = at("2024-01-03 12:00:00")
    return spark.createDataFrame(
        [
            (1, 1, "A", "x", at_noon),
            (2, 2, "A", "x", at_noon),
            (3, 3, "A", "x", at_noon),
            (4, 3, "A", "x", at_noon),
            (5, 3, "B", "x", at_noon),
            (6, 9, "B", "x", at_noon),
            (7, 4, None, "x", at_noon),
            (8, None, "C", "x", at_noon),
        ],
        schemas.LOGS,
    )


def test_currency_totals_drops_null_and_other_currencies(deals):
    assert rows(transactions.currency_totals(deals)) == [("EUR", 10.0), ("USD", 10.0)]


def test_fraud_summary_keeps_the_null_group(deals):
    assert rows(transactions.fraud_summary(deals)) == rows_of(
        [(0, 2, 12.5, 6.25), (1, 2, 10.0, 10.0), (None, 1, 5.0, 5.0)]
    )


def rows_of(values):
    return sorted(values, key=repr)


def test_daily_transactions_splits_at_midnight(deals):
    assert rows(transactions.daily_transactions(deals)) == rows_of(
        [
            (dt.date(2024, 1, 1), 1, 10.0, 10.0),
            (dt.date(2024, 1, 2), 3, 17.5, 17.5 / 3),
            (None, 1, None, None),
        ]
    )


def test_logs_per_transaction_counts_and_orders(deals, notes):
    result = transactions.logs_per_transaction(notes, deals).collect()
    assert [tuple(row) for row in result] == [(1, 1), (2, 1), (4, 1), (3, 3)]


def test_logs_per_transaction_multiplies_repeated_transactions(deals, notes):
    result = transactions.logs_per_transaction(notes, deals.union(deals))
    assert rows(result) == [(1, 2), (2, 2), (3, 6), (4, 2)]


def test_category_rollup_adds_equal_amounts_once(deals, notes):
    assert rows(transactions.category_rollup(notes, deals)) == rows_of(
        [("A", 3, 15.0, 7.5), ("B", 1, 5.0, 5.0), (None, 1, 2.5, 2.5)]
    )


def test_category_rollup_exact_adds_every_transaction(deals, notes):
    assert rows(transactions.category_rollup_exact(notes, deals)) == rows_of(
        [("A", 3, 25.0, 25.0 / 3), ("B", 1, 5.0, 5.0), (None, 1, 2.5, 2.5)]
    )


def counted_values(notes, deals):
    """What the reports should give, counted over the collected rows: per category the number of
    its transactions, and the set of their mean amounts."""
    amounts = {}
    for deal in deals.collect():
        amounts.setdefault(deal.transaction_id, []).append(deal.amount)
    held = {}
    for note in notes.collect():
        if note.transaction_id in amounts:
            held.setdefault(note.category, set()).add(note.transaction_id)
    found = {}
    for category, keys in held.items():
        known = [[a for a in amounts[key] if a is not None] for key in keys]
        found[category] = len(keys), {sum(some) / len(some) if some else None for some in known}
    return found


def random_case(spark, seed):
    """Few values, many repeats, NULLs, orphans, and a third of the logs on one key."""
    source = random.Random(seed)
    deals = [
        (source.randint(1, 12), 1, source.choice([1.0, 2.0, 4.0, None]), "USD", None, 0) for _ in range(20)
    ]
    notes = [
        (
            n,
            7 if n % 3 == 0 else source.choice([*range(1, 15), None]),
            source.choice(["A", "B", "C", None]),
            "x",
            None,
        )
        for n in range(60)
    ]
    return (
        spark.createDataFrame(deals, schemas.TRANSACTIONS),
        spark.createDataFrame(notes, schemas.LOGS),
    )


@pytest.mark.parametrize("seed", range(4))
def test_category_values_equal_a_count_over_all_rows(spark, seed):
    deals, notes = random_case(spark, seed)
    expected = counted_values(notes, deals)
    assert rows(transactions.category_values(notes, deals)) == rows_of(
        (category, n, mean) for category, (n, means) in expected.items() for mean in means
    )
    rolled = []
    for category, (n, means) in expected.items():
        some = [mean for mean in means if mean is not None]
        rolled.append((category, n, sum(some) if some else None, sum(some) / len(some) if some else None))
    assert rows(transactions.category_rollup(notes, deals)) == rows_of(rolled)


@pytest.mark.parametrize("seed", range(3))
def test_joined_reports_equal_the_plain_join(spark, seed):
    deals, notes = random_case(spark, seed)
    plain = notes.join(deals, "transaction_id").groupBy("transaction_id").count()
    assert rows(transactions.logs_per_transaction(notes, deals)) == rows(plain)
    goods = notes.select(
        F.col("transaction_id").alias("order_id"),
        F.col("category").alias("product_name"),
        (F.col("log_id") % 5).cast("decimal(12,2)").alias("product_price"),
        (F.col("log_id") % 3).cast("int").alias("quantity"),
    )
    bought = deals.select(F.col("transaction_id").alias("order_id"))
    joined = bought.join(goods, "order_id")
    value = F.sum(F.col("product_price") * F.col("quantity")).cast("double")
    per_order = joined.groupBy("order_id").agg(F.sum("quantity").cast("double"), value)
    ours = orders.order_item_totals(bought, goods)
    assert rows(ours.select("order_id", *[F.col(c).cast("double") for c in ours.columns[1:]])) == rows(per_order)
    per_product = joined.groupBy("product_name").agg(
        F.sum("quantity").cast("double"),
        F.sum("product_price").cast("double") / F.count("product_price"),
        value,
    )
    ours = orders.product_sales(bought, goods)
    assert rows(ours.select("product_name", *[F.col(c).cast("double") for c in ours.columns[1:]])) == rows(per_product)


@pytest.mark.parametrize("seed", range(3))
def test_dense_ranks_equal_the_window_form(spark, seed):
    _, notes = random_case(spark, seed)
    window = Window.partitionBy("category")
    expected = notes.select(
        "category",
        "transaction_id",
        F.dense_rank().over(window.orderBy("transaction_id")).cast("bigint"),
        F.dense_rank().over(window.orderBy(F.desc("transaction_id"))).cast("bigint"),
    ).distinct()
    assert rows(dense_ranks(notes, ["category"], "transaction_id")) == rows(expected)


def test_dense_ranks_span_slices(spark):
    """One partition over many slices: positions continue from slice to slice."""
    values = spark.range(5000).selectExpr("'A' AS c", "id * 3 AS v")
    ranked = dense_ranks(values, ["c"], "v")
    wrong = ranked.where((F.col("v") / 3 + 1 != F.col("rank_ascending"))
                         | (F.col("rank_ascending") + F.col("rank_descending") != 5001))
    assert ranked.count() == 5000 and wrong.count() == 0


def test_partition_average_on_every_row(deals):
    result = partition_average(deals.select("user_id", "amount"), ["user_id"], "amount", "mean")
    assert rows(result) == rows_of(
        [(10, 10.0, 10.0), (10, 10.0, 10.0), (11, 5.0, 3.75), (11, 2.5, 3.75), (12, None, None)]
    )


@pytest.fixture(scope="module")
def purchases(spark):
    price = Decimal("10.00")
    return spark.createDataFrame(
        [
            (1, 1, at("2024-12-30 10:00:00"), price, "paid"),
            (2, 1, at("2024-12-30 23:59:59"), Decimal("5.50"), "paid"),
            (3, 2, at("2024-12-31 00:00:00"), Decimal("15.50"), "open"),
            (4, 2, at("2023-01-01 00:00:00"), Decimal("0.00"), None),
            (5, 3, at("2023-01-01 05:00:00"), Decimal("99.99"), "open"),
        ],
        schemas.ORDERS,
    )


@pytest.fixture(scope="module")
def goods(spark):
    return spark.createDataFrame(
        [
            (1, 1, "pen", Decimal("1.50"), 2),
            (2, 1, "book", Decimal("10.00"), 1),
            (3, 3, "pen", Decimal("2.50"), 4),
            (4, 99, "pen", Decimal("9.99"), 9),
            (5, 2, "ink", None, None),
        ],
        schemas.ORDER_ITEMS,
    )


def test_payment_status_summary(purchases):
    assert rows(orders.payment_status_summary(purchases)) == rows_of(
        [
            ("paid", 2, Decimal("15.50"), 7.75),
            ("open", 2, Decimal("115.49"), 57.745),
            (None, 1, Decimal("0.00"), 0.0),
        ]
    )


def test_order_item_totals_leave_out_orphans(purchases, goods):
    assert rows(orders.order_item_totals(purchases, goods)) == rows_of(
        [(1, 3, Decimal("13.00")), (3, 4, Decimal("10.00")), (2, None, None)]
    )


def test_product_sales(purchases, goods):
    assert rows(orders.product_sales(purchases, goods)) == rows_of(
        [
            ("pen", 6, 2.0, Decimal("13.00")),
            ("book", 1, 10.0, Decimal("10.00")),
            ("ink", None, None, None),
        ]
    )


def test_daily_orders_label_uses_the_iso_year_and_sorts_by_day(purchases):
    result = [tuple(row) for row in orders.daily_orders(purchases).collect()]
    assert result == [
        ("Sun 01 Jan 2022", 2, Decimal("99.99"), 49.995),
        ("Mon 30 Dec 2025", 2, Decimal("15.50"), 7.75),
        ("Tue 31 Dec 2025", 1, Decimal("15.50"), 15.5),
    ]


def test_user_order_ranking_breaks_ties_by_user(purchases):
    result = [tuple(row) for row in orders.user_order_ranking(purchases).collect()]
    assert result == [(1, 2, Decimal("15.50")), (2, 2, Decimal("15.50")), (3, 1, Decimal("99.99"))]


def test_random_orders_match_a_plain_python_count(spark):
    source = random.Random(5)
    data = [(n, source.randint(1, 9), None, Decimal(source.randint(0, 99)), "x") for n in range(200)]
    counts = defaultdict(lambda: [0, Decimal(0)])
    for _, user, _, amount, _ in data:
        counts[user][0] += 1
        counts[user][1] += amount
    expected = sorted(((u, c, t) for u, (c, t) in counts.items()), key=lambda r: (-r[1], -r[2], r[0]))
    result = orders.user_order_ranking(spark.createDataFrame(data, schemas.ORDERS)).collect()
    assert [tuple(row) for row in result] == expected
