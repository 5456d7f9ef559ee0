"""Micro-batch writers that give the same table however often a batch is repeated."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tidemill.operators.clean import accepted, rejected, with_reject_reason
from tidemill.scratch import discard, new_path, write_at


def folder_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Write each batch to its own ``batch_id`` folder, replacing an earlier attempt."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write_batch


def checked_batches(
    write_good: Callable[[DataFrame, int], None],
    write_bad: Callable[[DataFrame, int], None],
    required: Sequence[str],
) -> Callable[[DataFrame, int], None]:
    """Send rows complete in ``required`` to ``write_good`` and the others to ``write_bad``.

    The batch is decoded once and kept in the shared folder until both have written.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = new_path(spark, "checked-batch")
        checked = write_at(with_reject_reason(batch, required), path)
        write_good(accepted(checked), batch_id)
        write_bad(rejected(checked), batch_id)
        discard(spark, path)

    return write_batch
