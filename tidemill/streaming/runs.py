"""Starting streams: drained once or run at an interval, always with a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Time between micro-batches.
INTERVAL = "10 seconds"


def drain_to_text(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what has arrived by now to text files, then stop; a later run goes on from there."""
    return (
        stream.writeStream.format("text")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )


def drain_to_memory(stream: DataFrame, name: str) -> StreamingQuery:
    """Collect what has arrived by now in the table ``name`` in driver memory.

    For looking at small streams and for tests; ``drain_to_text`` serves any size.
    """
    return (
        stream.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    )


def start_batches(
    stream: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    interval: str = INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Call ``write_batch(batch, batch_id)`` for each micro-batch."""
    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
