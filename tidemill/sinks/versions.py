"""Versions of a table: each lists the folders or files the table consists of.

A version is a small Parquet folder below ``<root>/versions``. Spark marks it as complete after its
last file, and readers take the highest complete one: a writer that is lost before that mark
leaves the version before in force. A version is written once, so of two writers that start
from the same version the later one fails and may start again. The number of entries must suit
the driver, which lists the paths of a scan in any case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.sources.folders import child_names, delete, exists

_VERSIONS = "versions"
_COMPLETE = "_SUCCESS"


def _path(root: str, version: int) -> str:
    return f"{root}/{_VERSIONS}/v{version:012d}"


def known_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, in order."""
    names = child_names(spark, f"{root}/{_VERSIONS}")
    numbers = sorted(int(name[1:]) for name in names if name.startswith("v"))
    return [n for n in numbers if exists(spark, f"{_path(root, n)}/{_COMPLETE}")]


def current_version(spark: SparkSession, root: str) -> int:
    """The version in force; 0 where there is none yet."""
    return max(known_versions(spark, root), default=0)


def read_version(spark: SparkSession, root: str, version: int, schema: StructType | str) -> DataFrame:
    """Entries of a version; none for version 0."""
    if version == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_path(root, version))


def publish_version(entries: DataFrame, root: str, version: int) -> None:
    """Write ``entries`` as ``version``; fails if another writer has written it.

    What a lost writer left of this version is removed first, as it was never in force.
    """
    spark, path = entries.sparkSession, _path(root, version)
    if exists(spark, path) and not exists(spark, f"{path}/{_COMPLETE}"):
        delete(spark, path)
    entries.coalesce(1).write.mode("error").parquet(path)


def expire(spark: SparkSession, root: str, schema: StructType | str, *, keep: int, data: str = "data") -> list[str]:
    """Delete versions before the last ``keep`` and the folders below ``<root>/<data>`` that none of those
    names; return the folders. Only for a time when nobody reads the older versions or writes."""
    versions = known_versions(spark, root)
    kept = versions[-keep:]
    needed: set[str] = set()
    for version in kept:
        paths = read_version(spark, root, version, schema).select("path").where(F.col("path").isNotNull()).distinct()
        needed |= {row.path.split("/")[1] for row in paths.collect()}
    gone = [name for name in child_names(spark, f"{root}/{data}") if name not in needed]
    for name in gone:
        delete(spark, f"{root}/{data}/{name}")
    for version in versions[: -keep or None]:
        delete(spark, _path(root, version))
    return gone
