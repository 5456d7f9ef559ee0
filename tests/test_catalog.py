"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from compare import connect, same_rows
from tidemill import catalog

FOLDER = os.environ.get("TIDEMILL_TEST_TABLES", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def oracle():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(entry_points.queries())


def test_entry_runs(spark):
    assert entry_points.entry(spark).columns == [
        "category_name",
        "transactions_count",
        "total_amount",
        "avg_amount",
    ]


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_matches_sql(name, spark, oracle):
    result = entry_points.queries()[name](spark, FOLDER)
    assert same_rows(result, entry_points.oracle_sql()[name], oracle) > 0
