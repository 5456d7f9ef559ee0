"""Records whose fields change their type: kept as they came, typed where they fit, with a reason where not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType, TimestampNTZType, TimestampType

RECORD = "record"
REASONS = "field_reasons"


def parsed(records: DataFrame, text: str = "value") -> DataFrame:
    """``record``: the JSON of a text column as a VARIANT, NULL for text that is none."""
    return records.withColumn(RECORD, F.try_parse_json(text))


def _field(name: str) -> Column:
    return F.variant_get(RECORD, f"$['{name}']", "variant")


def _kind(part: Column) -> Column:
    """Name of a JSON type: the number types are one, and so are all objects and all arrays."""
    schema = F.schema_of_variant(part)
    return (
        F.when(schema.rlike(r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit("number"))
        .when(schema.startswith("OBJECT"), F.lit("object"))
        .when(schema.startswith("ARRAY"), F.lit("array"))
        .when(schema == "VOID", F.lit("null"))
        .otherwise(F.lower(schema))
    )


def _value(field: StructField) -> Column:
    found = F.try_variant_get(RECORD, f"$['{field.name}']", field.dataType.simpleString())
    if isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType)):
        return F.when(_kind(_field(field.name)) == "string", found)
    return found


def typed_fields(records: DataFrame, schema: StructType, text: str = "value") -> DataFrame:
    """The fields of ``schema``, the whole ``record``, and for each field that is NULL the reason.

    Text that spells a number or a time is taken as one, but a number is no time. ``field_reasons`` maps a field to ``no record``, ``missing``,
    ``null``, or the JSON type found where a value of another type was asked for.
    """
    rows = parsed(records, text)
    values = {f.name: _value(f) for f in schema}
    reasons = []
    for field in schema:
        part = _field(field.name)
        why = (
            F.when(F.col(RECORD).isNull(), F.lit("no record"))
            .when(part.isNull(), F.lit("missing"))
            .when(values[field.name].isNull(), _kind(part))
        )
        reasons.append(F.struct(F.lit(field.name).alias("key"), why.alias("value")))
    known = F.filter(F.array(*reasons), lambda entry: entry["value"].isNotNull())
    return rows.select(
        *[value.alias(name) for name, value in values.items()], RECORD, F.map_from_entries(known).alias(REASONS)
    )


def field_types(records: DataFrame, schema: StructType, text: str = "value") -> DataFrame:
    """(field, kind, records): how often each field of ``schema`` comes in each JSON type, or not at all."""
    rows = parsed(records, text).where(F.col(RECORD).isNotNull())
    parts = F.array(
        *[
            F.struct(F.lit(f.name).alias("field"), F.coalesce(_kind(_field(f.name)), F.lit("missing")).alias("kind"))
            for f in schema
        ]
    )
    return rows.select(F.inline(parts)).groupBy("field", "kind").agg(F.count("*").alias("records"))


def common_schema(records: DataFrame, text: str = "value") -> str:
    """The schema all records agree on, drifting fields as VARIANT; one aggregate over the records."""
    rows = parsed(records, text)
    return rows.agg(F.schema_of_variant_agg(RECORD).alias("schema")).first().schema
