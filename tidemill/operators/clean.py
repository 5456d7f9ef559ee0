"""Casting to a schema, null handling, duplicates and rejected rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.functions.casts import TIME_PATTERN, cast_to

REASON = "reject_reason"


def cast_columns(df: DataFrame, schema: StructType, time_pattern: str = TIME_PATTERN) -> DataFrame:
    """Replace each column named in ``schema`` by its cast, in one projection."""
    types = {field.name: field.dataType for field in schema}
    return df.select(
        [
            cast_to(
                F.col(field.name), types[field.name], time_pattern, source=field.dataType
            ).alias(field.name)
            if field.name in types
            else F.col(field.name)
            for field in df.schema
        ]
    )


def conform_to_schema(df: DataFrame, schema: StructType, time_pattern: str = TIME_PATTERN) -> DataFrame:
    """Exactly the columns of ``schema``, matched by name; a missing column is NULL."""
    present = {field.name: field.dataType for field in df.schema}
    columns = []
    for field in schema:
        if field.name not in present:
            column = F.lit(None).cast(field.dataType)
        elif present[field.name] == field.dataType:
            column = F.col(field.name)
        else:
            source = present[field.name]
            column = cast_to(F.col(field.name), field.dataType, time_pattern, source=source)
        columns.append(column.alias(field.name))
    return df.select(columns)


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any column, or in any of ``subset``."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def drop_repeats(df: DataFrame) -> DataFrame:
    """One of each set of equal rows; copies are merged before the shuffle."""
    return df.dropDuplicates()


def with_reject_reason(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Add the names of the required columns that are NULL, or NULL for a good row."""
    missing = F.concat_ws(
        ",", *[F.when(F.col(name).isNull(), F.lit(name)) for name in required]
    )
    return df.withColumn(REASON, F.nullif(missing, F.lit("")))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNull()).drop(REASON)


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNotNull())
