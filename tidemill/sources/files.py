"""CSV, delimited text, JSON documents and Parquet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Free text may hold line breaks and doubled quotes.
FREE_TEXT_OPTIONS = {"multiLine": "true", "escape": '"'}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    schema: StructType | str | None = None,
    infer: bool = False,
    free_text: bool = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV with a header line. Without ``schema`` columns are text, or inferred on request.

    Free-text files are read one file per task, as a line break may be inside a value;
    ``free_text=False`` lets Spark split large files whose values hold none.
    """
    reader = spark.read.option("header", "true").option("inferSchema", str(infer).lower())
    if free_text:
        reader = reader.options(**FREE_TEXT_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**(options or {})).csv(path)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    *,
    sep: str = ",",
    header: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Delimited text of a given schema, in one splittable pass.

    A value that does not fit is NULL, a short line has a NULL tail, extra fields are
    dropped. Header names are not compared with the schema; columns go by position.
    """
    reader = spark.read.schema(schema).options(
        sep=sep, header=str(header).lower(), enforceSchema="true", mode="PERMISSIVE"
    )
    return reader.options(**(options or {})).csv(path)


def read_json_doc(
    spark: SparkSession,
    path: str | list[str],
    *,
    schema: StructType | str | None = None,
    one_per_line: bool = False,
) -> DataFrame:
    """Nested JSON, one document per file or per line; missing keys are NULL.

    Without ``schema`` the union of all keys is inferred in an extra pass.
    """
    reader = spark.read.option("multiLine", str(not one_per_line).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))
