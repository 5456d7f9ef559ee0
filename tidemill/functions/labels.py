"""Text forms of dates and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def start_of_day(column: Column) -> Column:
    return F.date_trunc("DAY", column)


def iso_day_label(column: Column) -> Column:
    """Weekday, day, month and ISO week year: 2024-12-30 is ``Mon 30 Dec 2025``."""
    return F.concat(
        F.date_format(column, "EEE dd MMM "),
        F.lpad(F.extract(F.lit("YEAROFWEEK"), column).cast("string"), 4, "0"),
    )


def interval_seconds(column: Column) -> Column:
    """Whole seconds of a day-time interval."""
    parts = {"DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1}
    total = F.lit(0).cast("bigint")
    for unit, factor in parts.items():
        total = total + F.extract(F.lit(unit), column).cast("bigint") * F.lit(factor)
    return total


def duration_text(seconds: Column) -> Column:
    """Seconds as ``HH:MM:SS``; hours run past 24, a negative duration has a sign."""
    whole = F.abs(seconds.cast("bigint"))
    hours = F.floor(whole / 3600).cast("string")
    return F.concat(
        F.when(seconds < 0, F.lit("-")).otherwise(F.lit("")),
        F.when(F.length(hours) < 2, F.lpad(hours, 2, "0")).otherwise(hours),
        F.lit(":"),
        F.lpad(F.floor(whole % 3600 / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((whole % 60).cast("string"), 2, "0"),
    )


def interval_text(column: Column) -> Column:
    """A day-time interval as ``HH:MM:SS``, for JSON text."""
    return duration_text(interval_seconds(column))
