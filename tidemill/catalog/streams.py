"""Streams over the test tables, each run until its input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.catalog.feeds import EVENT
from tidemill.catalog.tables import LAYOUTS, table
from tidemill.functions.records import encode_rows, times_as_text
from tidemill.plans import comments
from tidemill.scratch import new_path
from tidemill.sinks.files import write_text
from tidemill.sources.streams import folder_source
from tidemill.streaming.decode import decode_records, message_text
from tidemill.streaming.ledger import append_to_folder, committed_rows, ledger_batches
from tidemill.streaming.runs import drain_to_text, start_batches
from tidemill.streaming.sinks import checked_batches, folder_batches


# Files of a micro-batch; the topics below hold more, so that several batches run.
MAX_FILES = 4
TOPIC_FILES = 10


def _without_batch(rows: DataFrame) -> DataFrame:
    return rows.drop("batch_id").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _written(spark: SparkSession, target: str) -> DataFrame:
    return _without_batch(spark.read.parquet(target))


def _topic(records: DataFrame) -> str:
    """Records in the files of a folder, dealt out by content."""
    path = new_path(records.sparkSession, "topic")
    write_text(records.repartition(TOPIC_FILES, "value"), path)
    return path


def drain_messages(spark: SparkSession, folder: str) -> DataFrame:
    schema = LAYOUTS["events"]
    # As a pattern the table may be one file as well as a folder of files.
    records = folder_source(spark, f"{folder}/events.parque[t]", "parquet", schema=schema, max_files=MAX_FILES).select(
        F.encode("props", "UTF-8").alias("value")
    )
    target = new_path(spark, "messages")
    drain_to_text(message_text(records), target, new_path(spark, "checkpoint")).awaitTermination()
    return spark.read.text(target)


def _ingest(spark: SparkSession, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records through a topic folder and the stream into accepted and rejected tables."""
    good, bad = (new_path(spark, name) for name in ("accepted", "rejected"))
    topic = _topic(records)
    comments.stream_comments(
        folder_source(spark, topic, "text", max_files=MAX_FILES),
        checked_batches(folder_batches(good), folder_batches(bad), ["event_id", "value"]),
        new_path(spark, "checkpoint"),
        EVENT,
        available_now=True,
    ).awaitTermination()
    return spark.read.parquet(good), spark.read.parquet(bad)


def stream_comments(spark: SparkSession, folder: str) -> DataFrame:
    good, _ = _ingest(spark, encode_rows(times_as_text(table(spark, folder, "events"))))
    return _without_batch(good)


def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Records whose value is text: kept, with the reason, apart from the good rows."""
    events = times_as_text(table(spark, folder, "events"))
    wrong = events.where(F.col("event_type") == "error").withColumn("value", F.lit("n/a"))
    records = encode_rows(events.where(F.col("event_type") != "error")).union(encode_rows(wrong))
    _, bad = _ingest(spark, records)
    return bad.select("event_id", "user_id", "reject_reason")


def stream_at_interval(spark: SparkSession, folder: str) -> DataFrame:
    """Micro-batches started by the clock, stopped once all records are in."""
    target = new_path(spark, "batches")
    topic = _topic(encode_rows(times_as_text(table(spark, folder, "events"))))
    query = start_batches(
        decode_records(folder_source(spark, topic, "text", max_files=MAX_FILES), EVENT),
        folder_batches(target),
        new_path(spark, "checkpoint"),
        interval="1 second",
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return _written(spark, target)


def stream_restarted(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs on one checkpoint, each batch written twice: every record is there once."""
    target, checkpoint = (new_path(spark, name) for name in ("batches", "checkpoint"))
    topic = _topic(encode_rows(times_as_text(table(spark, folder, "events"))))
    write = folder_batches(target)

    def write_twice(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        write(batch, batch_id)

    for _ in range(2):
        comments.stream_comments(
            folder_source(spark, topic, "text", max_files=MAX_FILES),
            write_twice,
            checkpoint,
            EVENT,
            available_now=True,
        ).awaitTermination()
    return _written(spark, target)


def stream_committed(spark: SparkSession, folder: str) -> DataFrame:
    """An append-only sink: the first batch is appended once without a ledger row, and every batch is repeated."""
    staged, ledger, unseen = (new_path(spark, name) for name in ("staged", "ledger", "unseen-ledger"))
    topic = _topic(encode_rows(times_as_text(table(spark, folder, "events"))))
    write, lose = (ledger_batches(append_to_folder(staged), path, "comments") for path in (ledger, unseen))

    def write_repeatedly(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0:
            lose(batch, batch_id)
        write(batch, batch_id)
        write(batch, batch_id)

    comments.stream_comments(
        folder_source(spark, topic, "text", max_files=MAX_FILES),
        write_repeatedly,
        new_path(spark, "checkpoint"),
        EVENT,
        available_now=True,
    ).awaitTermination()
    rows = committed_rows(spark.read.parquet(staged), ledger)
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


QUERIES = {
    "stream_committed": stream_committed,
    "drain_messages": drain_messages,
    "stream_comments": stream_comments,
    "stream_rejects": stream_rejects,
    "stream_at_interval": stream_at_interval,
    "stream_restarted": stream_restarted,
}

_EVENTS = """
    SELECT event_id, ts, user_id, event_type, value, props FROM events
"""

SQL = {
    "stream_committed": _EVENTS,
    "drain_messages": "SELECT props AS value FROM events WHERE props IS NOT NULL",
    "stream_comments": _EVENTS,
    "stream_rejects": """
        SELECT event_id, user_id, 'value' AS reject_reason FROM events WHERE event_type = 'error'
    """,
    "stream_at_interval": _EVENTS,
    "stream_restarted": _EVENTS,
}
