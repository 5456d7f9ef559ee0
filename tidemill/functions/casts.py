"""Tolerant conversions: input that does not fit gives NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

# Time patterns of the feeds.
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
UTC_SUFFIX_PATTERN = "yyyy-MM-dd HH:mm:ss Z 'UTC'"

# The shapes of text worth parsing. A failed parse costs an exception, a failed match does
# not; and a plain cast of text known to have the shape is faster than parsing by pattern.
_TIME = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(\.\d{1,6})?\z"
_DATE = r"^\d{4}-\d\d-\d\d\z"
_KEY_DATE = r"^\d{4}-\d\d?-\d\d?( \d\d?:\d\d?:\d\d?)?\z"
_WHOLE = r"^\s*[+-]?\d+\s*$"
_BOOLEAN = r"(?i)^\s*(t|true|y|yes|1|f|false|n|no|0)\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Doubles hold every whole number up to here.
_EXACT_DOUBLE = 2**53


def cast_to(
    column: Column,
    data_type: DataType,
    time_pattern: str = TIME_PATTERN,
    *,
    source: DataType = StringType(),
) -> Column:
    """A column of type ``source`` as ``data_type``; NULL where the value does not fit.

    Whole-number targets accept text with a decimal spelling and truncate it. Dates and times
    are converted as they are, fractions of a second included, and text may hold a fraction too; a
    date is also read from text that holds only a date.
    """
    if isinstance(source, (DateType, TimestampType, TimestampNTZType)):
        return column if source == data_type else column.try_cast(data_type)
    if isinstance(data_type, DateType):
        text = column.cast("string")
        day = F.when(text.rlike(_DATE), text.try_cast("date"))
        return F.coalesce(day, parse_time(column, time_pattern).cast("date"))
    if isinstance(data_type, (TimestampType, TimestampNTZType)):
        return parse_time(column, time_pattern).cast(data_type)
    if isinstance(source, StringType) and isinstance(data_type, IntegralType):
        return _whole_number(column, data_type)
    if isinstance(source, StringType) and isinstance(data_type, BooleanType):
        return F.when(column.rlike(_BOOLEAN), column.try_cast(data_type))
    return column.try_cast(data_type)


def _whole_number(text: Column, data_type: DataType) -> Column:
    number = text.try_cast("double")
    return (
        F.when(text.rlike(_WHOLE), text.try_cast(data_type))
        .when(~text.rlike(_NUMBER), F.lit(None))
        .when(F.abs(number) < _EXACT_DOUBLE, number.try_cast(data_type))
        .otherwise(text.try_cast("decimal(38,10)").try_cast(data_type))
    )


def parse_time(column: Column, time_pattern: str = TIME_PATTERN) -> Column:
    """Time from text in a pattern; the default one may be followed by a fraction of a second, up to six digits."""
    text = column.cast("string")
    if time_pattern == TIME_PATTERN:
        return F.when(text.rlike(_TIME), text.try_cast("timestamp"))
    return F.try_to_timestamp(text, F.lit(time_pattern))


def parse_amount(column: Column, precision: int = 14, scale: int = 2) -> Column:
    """Money text, scientific spelling included: ``78322e-2`` is 783.22."""
    return F.trim(column).try_cast(f"decimal({precision},{scale})")


def parse_utc_ts(column: Column) -> Column:
    """Text such as ``2001-02-13 00:00:00 +0000 UTC``."""
    return F.try_to_timestamp(column, F.lit(UTC_SUFFIX_PATTERN))


def parse_key_date(column: Column) -> Column:
    """Date from a date or date-and-time key; NULL for any other text."""
    return F.when(column.rlike(_KEY_DATE), column.try_cast("timestamp_ntz")).cast("date")


def date_or_text(column: Column) -> Column:
    """The key's date as ``yyyy-MM-dd`` text, or the key itself where it is no date."""
    return F.coalesce(parse_key_date(column).cast("string"), column)


def number_or_zero(column: Column, data_type: str, *, strict: bool = True) -> Column:
    """NULL and empty text become 0. Text that is no number fails if ``strict``, else becomes 0;
    a number that ``data_type`` cannot hold always fails."""
    text = column.cast("string")
    zero = F.lit(0).cast(data_type)
    raised = lambda reason: F.raise_error(F.concat(F.lit(f"{reason}: "), text)).cast(data_type)
    malformed = raised("not a number") if strict else zero
    unfit = F.when(text.rlike(_NUMBER), raised(f"not a value of {data_type}")).otherwise(malformed)
    return F.when(text.isNull() | (text == ""), zero).otherwise(F.coalesce(text.try_cast(data_type), unfit))


def exactly(column: Column, data_type: str) -> Column:
    """A number as ``data_type``; fails where it does not fit rather than giving NULL."""
    unfit = F.raise_error(F.concat(F.lit(f"not a value of {data_type}: "), column.cast("string")))
    return F.when(column.isNotNull(), F.coalesce(column.try_cast(data_type), unfit.cast(data_type)))
