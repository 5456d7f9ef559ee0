"""Aggregate states that can be merged, so that a report follows its loads without rereading them.

A state has a row per key (and, for distinct numbers, per stretch of 32,768 of them). States of loads or
micro-batches are kept side by side, a repeated load replacing its own, and folded when read: the
result is that of one pass over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PART, _BITS = "id_part", "id_bits"
_ROWS, _VALUES, _TOTAL = "rows_seen", "values_seen", "total_seen"


def sum_state(rows: DataFrame, keys: Sequence[str | Column], value: str) -> DataFrame:
    """Rows, non-NULL values and exact sum of a decimal ``value`` for each key."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias(_ROWS), F.count(value).alias(_VALUES), F.sum(F.col(value).cast("decimal(38,2)")).alias(_TOTAL)
    )


def merge_sums(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state for each key; merging merged states changes nothing."""
    merged = [F.sum(name).alias(name) for name in (_ROWS, _VALUES)]
    return states.groupBy(*keys).agg(*merged, F.sum(_TOTAL).cast("decimal(38,2)").alias(_TOTAL))


def finish_sums(states: DataFrame, keys: Sequence[str], *, count: str, total: str, mean: str) -> DataFrame:
    """Count, total and average for each key."""
    merged = merge_sums(states, keys)
    average = F.col(_TOTAL).cast("double") / F.nullif(F.col(_VALUES), F.lit(0))
    return merged.select(*keys, F.col(_ROWS).alias(count), F.col(_TOTAL).alias(total), average.alias(mean))


def distinct_state(rows: DataFrame, keys: Sequence[str | Column], number: str) -> DataFrame:
    """The different whole numbers of each key as bitmaps; NULL is no number.

    A bitmap covers 32,768 numbers in a row with 4 kB, so it suits numbers given out one after the other: a key
    with ``n`` of them up to ``m`` takes at most 4 kB for each 32,768 of ``m``.
    """
    known = rows.where(F.col(number).isNotNull())
    return known.groupBy(*keys, F.bitmap_bucket_number(number).alias(_PART)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(_BITS)
    )


def merge_distinct(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state for each key; merging merged states changes nothing."""
    return states.groupBy(*keys, _PART).agg(F.bitmap_or_agg(_BITS).alias(_BITS))


def finish_distinct(states: DataFrame, keys: Sequence[str], *, count: str) -> DataFrame:
    """The exact number of different numbers of each key."""
    merged = merge_distinct(states, keys)
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count(_BITS)).alias(count))
