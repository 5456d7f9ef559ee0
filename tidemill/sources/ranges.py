"""Ranges of a key for reading a table in balanced parts, and rows of a table by day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Cut = int | float | Decimal | dt.date | dt.datetime | str


def quantile_cuts(keys: DataFrame, column: str, parts: int, *, accuracy: int = 10_000) -> list:
    """Values that cut the rows of a number or time column into about equal ``parts``, however they are spread.

    A value that holds more than a part is a cut once, so there may be fewer. NULL and NaN count for no part.
    One pass that reads this column alone and brings ``parts`` values to the driver.
    """
    shares = [n / parts for n in range(1, parts)]
    if not shares:
        return []
    kind = dict(keys.dtypes)[column]
    number = F.col(column) if kind not in ("date", "timestamp", "timestamp_ntz") else F.col(column).cast("timestamp")
    known = keys.where(~F.isnan(column)) if kind in ("float", "double") else keys
    found = known.agg(F.percentile_approx(number, shares, accuracy).cast(f"array<{kind}>").alias("cuts")).first().cuts
    return sorted(set(found or []))


def _literal(value: Cut) -> str:
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return repr(value) if isinstance(value, float) else str(value)


def range_predicates(column: str, cuts: Sequence[Cut]) -> list[str]:
    """Conditions of which every row meets exactly one: below the first cut, between cuts, from the last on, NULL.

    For the ``predicates`` of a database reader, which reads one partition for each.
    """
    edges = [_literal(cut) for cut in sorted(set(cuts))]
    if not edges:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(edges, edges[1:])]
    return [f"{column} < {edges[0]}", *between, f"{column} >= {edges[-1]}", f"{column} IS NULL"]


def rows_of_days(fact: DataFrame, days: DataFrame, day: str) -> DataFrame:
    """Rows of a table that lies by ``day``, for the days a filtered table names.

    Where ``days`` filters a table Spark knows to be small, it is read first and the scan of ``fact`` opens
    only the folders of its days, although they are not known when the query is planned.
    """
    return fact.join(days.select(day).distinct(), day)
