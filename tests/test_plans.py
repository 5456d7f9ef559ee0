"""Physical plans of the registered queries: no cross joins, no Python, pruned scans."""

from __future__ import annotations

import re

import pytest

from tidemill import catalog

FOLDER = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cross_join_and_no_python(name, spark):
    text = physical(catalog.queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in text


@pytest.mark.parametrize(
    "name", ["logs_per_transaction", "category_rollup", "category_rollup_exact", "product_sales", "order_item_totals"]
)
def test_reports_use_no_window(name, spark):
    """Reports of fact rows are aggregates and joins; ``test_skew`` tests how they hold on a hot key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = physical(catalog.queries()[name](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" not in text
    assert "Aggregate" in text


@pytest.mark.parametrize("name", ["aircraft_seat_document", "booking_document"])
def test_documents_are_not_shuffled_after_they_are_built(name, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = physical(catalog.queries()[name](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above = text.split("collect_list", 1)[0]
    assert "collect_list" in text and "Exchange" not in above


def test_currency_filter_reaches_the_scan(spark):
    text = physical(catalog.queries()["currency_totals"](spark, FOLDER))
    assert "PushedFilters: [In(o_orderpriority" in text
    assert "ReadSchema: struct<o_totalprice:double,o_orderpriority:string>" in text


def test_time_filter_reaches_the_scan(spark):
    text = physical(catalog.queries()["parquet_filter"](spark, FOLDER))
    assert "GreaterThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string,l_shipdate:timestamp_ntz>" in text


def test_reports_shuffle_once(spark):
    for name in ("currency_totals", "fraud_summary", "daily_transactions", "payment_status_summary"):
        text = physical(catalog.queries()[name](spark, FOLDER))
        assert len(re.findall(r"Exchange hashpartitioning", text)) == 1, name
