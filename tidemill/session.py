"""Session defaults the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Target size of one shuffle partition: small enough to sort in executor memory.
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def build_session(
    app_name: str,
    *,
    master: str | None = None,
    shuffle_partitions: int,
    options: dict[str, str] | None = None,
) -> SparkSession:
    """Session in UTC with adaptive execution on.

    ``shuffle_partitions`` is what the largest shuffle needs (``shuffle_partitions_for``): adaptive
    execution merges partitions but adds none to a sort. ``spark.checkpoint.dir`` is left to the cluster; see ``tidemill.scratch``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in (options or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shuffle_partitions_for(shuffle_bytes: int, cores: int) -> int:
    """Partition count for a shuffle of ``shuffle_bytes``; adaptive execution merges small ones.

    100 TB gives about 750,000 partitions of 128 MB; a job that prunes columns first
    shuffles, and so needs, far less. Never fewer than the cores of the cluster.
    """
    return max(cores, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))
