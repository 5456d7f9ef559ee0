"""Catalog tables and relational databases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view of the session's catalog."""
    return spark.table(name)


def jdbc_options(
    connection: Mapping[str, str],
    query: str,
    *,
    partitions: int,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a query, run as ``partitions`` ranges of ``partition_column``.

    The query goes in as a derived table because Spark does not partition a ``query``.
    One partition reads the whole query in one task. ``bounds`` only place the ranges; rows outside them are read by the outer ranges.
    """
    options = {**connection, "dbtable": f"({query.strip().rstrip(';')}) source_rows", "fetchsize": str(fetch_size)}
    if partitions == 1 and partition_column is None:
        return options
    if partition_column is None or bounds is None or partitions < 2:
        raise ValueError("a partitioned read needs a column, bounds and at least two partitions")
    return {
        **options,
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, connection: Mapping[str, str], query: str, **partitioning) -> DataFrame:
    """Rows of a query in a relational database; see ``jdbc_options``."""
    return spark.read.format("jdbc").options(**jdbc_options(connection, query, **partitioning)).load()


def read_jdbc_ranges(
    spark: SparkSession, connection: Mapping[str, str], query: str, predicates: Sequence[str], *, fetch_size: int = 10_000
) -> DataFrame:
    """The same with one partition for each condition, such as those of ``ranges.range_predicates``."""
    properties = {name: value for name, value in connection.items() if name != "url"} | {"fetchsize": str(fetch_size)}
    source = f"({query.strip().rstrip(';')}) source_rows"
    return spark.read.jdbc(connection["url"], source, predicates=list(predicates), properties=properties)
