"""Listing and deleting folders of any file system that Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, text: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(text)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    system, located = _located(spark, path)
    return system.exists(located)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is directly below ``path``, in order; none where it does not exist."""
    system, located = _located(spark, path)
    if not system.exists(located):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(located))


def delete(spark: SparkSession, path: str) -> bool:
    system, located = _located(spark, path)
    return system.delete(located, True)
