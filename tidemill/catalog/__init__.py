"""Every query of the library on the shared test tables, with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.catalog import documents, feeds, loads, reports, streams

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (reports, documents, feeds, loads, streams)


def queries() -> dict[str, Query]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
