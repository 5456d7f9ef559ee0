"""From record bytes to typed columns; the same functions serve batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from tidemill.functions.casts import TIME_PATTERN, parse_time
from tidemill.functions.records import decode_field
from tidemill.schemas import with_text_times


def message_text(records: DataFrame) -> DataFrame:
    """Non-NULL payloads as text."""
    return records.selectExpr("CAST(value AS STRING) AS value").where(F.col("value").isNotNull())


def decode_records(
    records: DataFrame, schema: StructType, time_pattern: str = TIME_PATTERN
) -> DataFrame:
    """JSON payloads as the columns of ``schema``; times arrive as text in ``time_pattern``."""
    decoded = (
        records.selectExpr("CAST(value AS STRING) AS json_str")
        .select(decode_field(F.col("json_str"), with_text_times(schema)).alias("data"))
        .select("data.*")
    )
    return decoded.select(
        [
            parse_time(F.col(field.name), time_pattern).alias(field.name)
            if isinstance(field.dataType, TimestampType)
            else F.col(field.name)
            for field in schema
        ]
    )
