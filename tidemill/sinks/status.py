"""Publishing with a status that comes from the writing itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.folders import child_names, exists


def observed_write(records: DataFrame, write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Write ``records`` and return how many rows and bytes of ``value`` the writing tasks saw.

    Counted while the rows pass, by the successful tasks only; nothing is read twice.
    """
    seen = Observation()
    write(records.observe(seen, F.count("*").alias("records"), F.sum(F.octet_length("value")).alias("bytes")))
    return {name: int(number or 0) for name, number in seen.get.items()}


def publish_to_folder(records: DataFrame, path: str, topic: str = "topic") -> dict[str, int]:
    """Write the ``value`` of records as lines, a folder for each ``topic`` and a file for each task."""

    def write(rows: DataFrame) -> None:
        rows.select(topic, "value").write.partitionBy(topic).text(path)

    return observed_write(records, write)


def written_status(spark: SparkSession, path: str, topic: str = "topic") -> DataFrame:
    """(topic, partition, records) read from the files that publishing left, a row per writing task and topic."""
    schema = f"value string, {topic} string"
    partition = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int")
    return spark.read.schema(schema).text(path).groupBy(topic, partition.alias("partition")).agg(F.count("*").alias("records"))


def confirm(spark: SparkSession, path: str, observed: dict[str, int], topic: str = "topic") -> DataFrame:
    """The status of a publication whose files hold what the writers saw; fails otherwise."""
    if not exists(spark, path) or not [name for name in child_names(spark, path) if "=" in name]:
        found = 0
        status = spark.createDataFrame([], f"{topic} string, partition int, records long")
    else:
        status = written_status(spark, path, topic)
        found = status.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("n")).first().n
    if found != observed["records"]:
        raise ValueError(f"{observed['records']} records were sent and {found} are at {path}")
    return status
