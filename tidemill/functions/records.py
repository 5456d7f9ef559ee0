"""JSON records: whole rows as text and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType, TimestampType

from tidemill.functions.casts import TIME_PATTERN


def times_as_text(df: DataFrame, time_pattern: str = TIME_PATTERN) -> DataFrame:
    """Timestamps as text that the reader parses, so a JSON round trip is exact.

    The default pattern is followed by the fraction of the second, if there is one; another
    pattern says itself what it keeps.
    """

    def text(name: str) -> Column:
        return F.col(name).cast("string") if time_pattern == TIME_PATTERN else F.date_format(name, time_pattern)

    return df.select(
        [
            text(field.name).alias(field.name)
            if isinstance(field.dataType, (TimestampType, TimestampNTZType))
            else F.col(field.name)
            for field in df.schema
        ]
    )


def object_text(columns: Sequence[str | Column], *, keep_nulls: bool) -> Column:
    """JSON object text; NULL fields are left out, or kept as ``null`` if ``keep_nulls``."""
    options = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*columns), options)


def encode_rows(df: DataFrame, *, keep_nulls: bool = False) -> DataFrame:
    """One ``value`` column holding each row as a JSON object."""
    return df.select(object_text(df.columns, keep_nulls=keep_nulls).alias("value"))


def decode_field(column: Column, schema: StructType | str) -> Column:
    """Struct from JSON text: all NULL for bad text, one NULL for a bad field."""
    return F.from_json(column, schema)
