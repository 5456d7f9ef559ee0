"""Intermediate tables in the folder all executors share.

A written table cuts lineage without tying rows to one executor, and it gives Spark a real
size: a join with it is broadcast only if the files are below
``spark.sql.autoBroadcastJoinThreshold``, and otherwise is a sort-merge join of two plain
shuffles, which is the shape adaptive execution can split on a skewed key.
"""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_handed_out: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tidemill-")
    return _local_folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has written to."""
    path = f"{shared_folder(spark)}/tidemill/{name}-{uuid.uuid4().hex}"
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and return the table read back."""
    return write_at(df, new_path(df.sparkSession, name))


def write_at(df: DataFrame, path: str) -> DataFrame:
    """The same at a path of ``new_path``, for a caller that will ``discard`` it."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, text: str) -> bool:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(text)
    return path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a path of ``new_path`` that nothing reads any more, before the job's end."""
    _handed_out[spark.sparkContext.applicationId].remove(path)
    _delete(spark, path)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete shuffle files that nothing refers to any more.

    It does so only when the driver's garbage is collected, which a job with much
    data and few objects on the driver may not reach before its disks are full. Events
    that listeners have yet to read hold the query that ended last.
    """
    with contextlib.suppress(Py4JJavaError):
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release(spark: SparkSession) -> int:
    """Delete what this application has written below the shared folder; return how many paths.

    For the end of a job: tables returned earlier read these files.
    """
    return sum(_delete(spark, path) for path in _handed_out.pop(spark.sparkContext.applicationId, []))
