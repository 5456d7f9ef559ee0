"""Publishing records to Kafka."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kafka_sink_options(connection: Mapping[str, str], topic: str) -> dict[str, str]:
    return {**connection, "topic": topic}


def publish(records: DataFrame, connection: Mapping[str, str], topic: str) -> None:
    """Send the ``value`` column; each partition is written by its own task and producer."""
    options = kafka_sink_options(connection, topic)
    records.select("value").write.format("kafka").options(**options).save()


def partition_status(records: DataFrame) -> DataFrame:
    """Records in each partition: what each publishing task has to send."""
    return records.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("records")
    )
