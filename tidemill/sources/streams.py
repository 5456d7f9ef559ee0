"""Unbounded inputs: Kafka topics and growing folders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Where a new subscription may start.
STARTING_OFFSETS = ("earliest", "latest")


def kafka_source_options(
    connection: Mapping[str, str],
    topic: str,
    *,
    max_offsets: int,
    starting: str = "earliest",
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options to subscribe to ``topic``. Servers and credentials come in ``connection``.

    ``max_offsets`` bounds a micro-batch, also when a backlog is drained; ``min_partitions`` splits large topic partitions.
    """
    if starting not in STARTING_OFFSETS:
        raise ValueError(f"starting must be one of {STARTING_OFFSETS}")
    options = {**connection, "subscribe": topic, "startingOffsets": starting}
    options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_source(
    spark: SparkSession, connection: Mapping[str, str], topic: str, **settings
) -> DataFrame:
    """Stream of a topic's records; the payload is the binary column ``value``."""
    return spark.readStream.format("kafka").options(**kafka_source_options(connection, topic, **settings)).load()


def folder_source(
    spark: SparkSession,
    path: str,
    file_format: str,
    *,
    max_files: int,
    schema: StructType | None = None,
) -> DataFrame:
    """Stream of the files in a folder, ``max_files`` to a micro-batch."""
    reader = spark.readStream.format(file_format)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.option("maxFilesPerTrigger", max_files).load(path)
