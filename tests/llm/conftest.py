"""Small document tables with the awkward rows."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs, or longer rows, with two columns of clashing names."""

    def make(rows, clash=True):
        full = [(*row, *(None, "src", 0)[len(row) - 2 :]) for row in rows]
        made = spark.createDataFrame(full, SCHEMA)
        return made.selectExpr("*", "'mine' AS score", "7 AS id") if clash else made

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in every column, empty and blank texts, one very long text, repeated rows and numbers."""
    return [
        (None, "ba dan ke fel", None, None, None),
        (1, None, "en", "a", None),
        (2, "", "en", None, 0),
        (3, " \t\n ", None, "b", 4),
        (4, "same words in this row", "en", "b", 22),
        (4, "same words in this row", "en", "b", 22),
        (4, "other words under one number", "de", "b", 28),
        (5, "Ünïcode ключ 漢字 \U0001f600 " * 3, "xx", "b", 60),
        (6, "x" * 300_000, "en", "c", 300_000),
        (7, "again and " * 40_000, "en", "c", 400_000),
    ]
