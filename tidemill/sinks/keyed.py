"""Tables in which a later load replaces rows of the same key.

Each load is a folder of its own, so a load costs what it brings, may be repeated safely and
never touches files being read. Replacement happens when the table is read or compacted, over all
loads; ``tidemill.sinks.buckets`` does it for what the loads touch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.winners import latest_rows

LOAD = "load_id"


def append_load(df: DataFrame, root: str, load_id: int) -> None:
    """Write one load; the same ``load_id`` again overwrites its own folder only."""
    df.write.mode("overwrite").parquet(f"{root}/{LOAD}={load_id}")


def read_loads(spark: SparkSession, root: str) -> DataFrame:
    """All rows of all loads, with the load they came in."""
    loads = spark.read.parquet(root)
    return loads.withColumn(LOAD, F.col(LOAD).cast("bigint"))


def read_latest(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """The row of the highest load for each key; equal loads go by full row order. Runs jobs."""
    return latest_rows(read_loads(spark, root), keys, LOAD).drop(LOAD)


def compact(spark: SparkSession, root: str, new_root: str, keys: Sequence[str], load_id: int) -> None:
    """Write the merged table to ``new_root`` as one load.

    Readers are pointed there afterwards, for a catalog table by ``tables.switch_location``.
    """
    append_load(read_latest(spark, root, keys), new_root, load_id)
