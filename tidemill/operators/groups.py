"""Group operators that hold when one key has a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def average(column: str | Column) -> Column:
    """Mean of the non-NULL values as double: exact decimal sum divided by their number."""
    return F.sum(column).cast("double") / F.count(column)


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the highest by ``order``, ties by the remaining columns.

    An aggregate, not a ranking window, so each task first reduces its own rows and a hot
    key reaches the shuffle as one row per task.
    """
    rest = [name for name in df.columns if name not in (*keys, *order)]
    if not order and not rest:
        return df.distinct()
    latest = F.max(F.struct(*order, *rest)).alias("latest")
    return df.groupBy(*keys).agg(latest).select(*keys, "latest.*").select(*df.columns)


def join_splittable(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    null_safe: bool = False,
) -> DataFrame:
    """Join on ``keys`` in a form that holds when one key has a large share of ``left``.

    Adaptive execution splits a skewed key only if both sides of the join come straight from
    a shuffle. Where one side is aggregated by the join keys Spark would reuse that
    partitioning; with the keys' hash as a further key it shuffles the (reduced) side again.
    The key columns are those of ``left``; ``null_safe`` lets NULL match NULL.
    """
    renamed = right.withColumnsRenamed({name: f"right_{name}" for name in keys})
    condition = F.xxhash64(*[left[name] for name in keys]) == F.xxhash64(
        *[renamed[f"right_{name}"] for name in keys]
    )
    for name in keys:
        ours, theirs = left[name], renamed[f"right_{name}"]
        condition = condition & (ours.eqNullSafe(theirs) if null_safe else ours == theirs)
    return left.join(renamed, condition, how).drop(*[f"right_{name}" for name in keys])


def partition_average(
    df: DataFrame, partition_by: Sequence[str], value: str, name: str
) -> DataFrame:
    """Average of ``value`` over each partition on every row, without a window."""
    summary = df.groupBy(*partition_by).agg(average(value).alias(name))
    return join_splittable(df, summary, partition_by, null_safe=True)
