"""The comment feed: cleaning, landing, publishing and streaming in."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemill import schemas
from tidemill.functions.casts import parse_time
from tidemill.functions.records import encode_rows, times_as_text
from tidemill.operators.clean import (
    accepted,
    cast_columns,
    conform_to_schema,
    drop_incomplete,
    drop_repeats,
    rejected,
    with_reject_reason,
)
from tidemill.operators.winners import latest_rows, on_files
from tidemill.scratch import discard, new_path, write_at
from tidemill.sinks.files import write_parquet
from tidemill.sinks.kafka import publish
from tidemill.sinks.landing import land
from tidemill.sources.files import read_csv
from tidemill.sources.free_text import read_free_text
from tidemill.streaming.decode import decode_records
from tidemill.streaming.runs import INTERVAL, start_batches


def clean_rows(
    raw: DataFrame, schema: StructType = schemas.COMMENTS, *, required: Sequence[str] | None = None
) -> DataFrame:
    """Typed, complete, distinct rows from text columns.

    ``required`` limits the NULL check, so that rows lacking only an optional text stay.
    """
    return drop_repeats(drop_incomplete(cast_columns(raw, schema), required))


def csv_to_parquet_clean(
    spark: SparkSession,
    source: str,
    target: str,
    schema: StructType = schemas.COMMENTS,
    *,
    required: Sequence[str] | None = None,
    rejects: str | None = None,
    free_text: bool = True,
    large_files: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Clean a headed CSV feed into Parquet at ``target`` and return the written table.

    All columns are read as text and cast in the same pass; nothing is inferred. Rows left out
    for a missing value go to ``rejects``, if given, with the names of the columns that lack one.
    Values may hold line breaks: then a file is read by one task, or with ``large_files`` by many, which costs
    a shuffle (``read_free_text``). ``free_text=False`` promises that none does, and lets files be split as they are.
    """
    text = schemas.as_text(schema)
    if large_files:
        raw = read_free_text(spark, source, text, options=options)
    else:
        raw = read_csv(spark, source, schema=text, free_text=free_text, options=options)
    if rejects is None:
        write_parquet(clean_rows(raw, schema, required=required), target)
        return spark.read.parquet(target)
    # Both tables come from one reading of the feed.
    path = new_path(spark, "checked-feed")
    checked = write_at(with_reject_reason(cast_columns(raw, schema), required or schema.names), path)
    write_parquet(rejected(checked), rejects)
    write_parquet(drop_repeats(accepted(checked)), target)
    discard(spark, path)
    return spark.read.parquet(target)


def publish_json(df: DataFrame, options: Mapping[str, str], topic: str) -> None:
    """Publish each row as a JSON record."""
    publish(encode_rows(times_as_text(df)), options, topic)


def stream_comments(
    records: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    schema: StructType = schemas.COMMENTS,
    *,
    serving: StructType | None = None,
    interval: str = INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Decode JSON records and hand each micro-batch to ``write_batch`` in the types of ``serving``.

    The serving table of comments takes the place of ``serving`` for the schema of comments;
    another schema stays as it is unless ``serving`` is given.
    """
    if serving is None:
        serving = schemas.comments_serving() if schema == schemas.COMMENTS else schema
    return start_batches(
        conform_to_schema(decode_records(records, schema), serving),
        write_batch,
        checkpoint,
        interval=interval,
        available_now=available_now,
    )


def _complete(required: Sequence[str]) -> Column:
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    return complete


def _time(rows: DataFrame, name: str) -> Column:
    """A column as a time, parsed if it is text."""
    return parse_time(F.col(name)) if dict(rows.dtypes)[name] == "string" else F.col(name)


def land_raw_comments(
    raw: DataFrame,
    target: str,
    *,
    key: Sequence[str] = (schemas.COMMENT_KEY,),
    required: Sequence[str] = schemas.COMMENT_REQUIRED,
    day_of: str = "created_time",
    then_by: str = "post_created_time",
) -> DataFrame:
    """Land one row per key, the last by row order, partitioned by day, and return the rows rejected.

    Rows with a NULL in ``required`` are rejected. ``day_of`` becomes the partition column
    ``<day_of>_day`` and ``then_by`` the order inside files, so that filters on either
    time read only part of the table. Days are written in pieces of the advisory size,
    however many rows one day holds.
    """
    complete, day = _complete(required), f"{day_of}_day"
    landed = latest_rows(on_files(raw).where(complete), key).withColumn(day, _time(raw, day_of).cast("date"))
    (
        landed.hint("rebalance", F.col(day))
        .sortWithinPartitions(day, then_by)
        .write.mode("overwrite")
        .partitionBy(day)
        .parquet(target)
    )
    return raw.where(~complete)


def land_comments(
    raw: DataFrame,
    root: str,
    *,
    key: Sequence[str] = (schemas.COMMENT_KEY,),
    required: Sequence[str] = schemas.COMMENT_REQUIRED,
    day_of: str = "created_time",
    then_by: str = "post_created_time",
) -> DataFrame:
    """Land a load in a table that holds one row per key over all loads, and return the rows rejected.

    Rows lie by the day of ``day_of`` (``<day_of>_day``); the days of ``then_by`` are indexed. Read the table with
    ``tidemill.sinks.landing.read_landed`` or, by days of ``then_by``, ``read_second_days``.
    """
    complete, day = _complete(required), f"{day_of}_day"
    rows = raw.where(complete).withColumn(day, _time(raw, day_of).cast("date"))
    second = None if dict(raw.dtypes)[then_by] == "string" else then_by
    if second is None:
        second = f"{then_by}_parsed"
        rows = rows.withColumn(second, _time(raw, then_by))
    land(rows, root, keys=key, day=day, order=then_by, second=second)
    return raw.where(~complete)
