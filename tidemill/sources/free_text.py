"""Large CSV files whose values hold line breaks, read by many tasks.

A line break inside quotes is part of a value, and whether a split of the file begins inside quotes
depends on all splits before it. Every split counts the quotes of its lines, and where records begin
both if it starts outside quotes and if it starts inside. The parities, composed over the splits of a file in
order, say which of both holds, and where the record that goes on from the split before began. Lines
that are a whole record pass as they are; only those of records of several lines are brought together.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidemill.functions.casts import cast_to
from tidemill.operators.groups import join_splittable
from tidemill.scratch import write_table

_SPLIT = ["file", "block"]


def _quotes(line: Column, quote: str) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(quote), F.lit("")))


def _counted_lines(spark: SparkSession, path: str | list[str], quote: str) -> DataFrame:
    """Lines with their split, their order in it, and how many records have begun in it up to each line,
    ``outside`` if the split starts outside quotes and ``inside`` if it starts inside.

    Written, as splits may be cut elsewhere in another scan of the files.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.regexp_replace("value", "\r$", "").alias("value"),
        _quotes(F.col("value"), quote).alias("quotes"),
    )
    so_far = Window.partitionBy(*_SPLIT).orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parity = (F.sum("quotes").over(so_far) - F.col("quotes")) % 2
    lines = lines.withColumn("parity", parity)
    counted = lines.select(
        *_SPLIT, "line", "value", "quotes", F.col("parity").cast("int").alias("parity"),
        F.sum(1 - F.col("parity")).over(so_far).alias("outside"),
        F.sum("parity").over(so_far).alias("inside"),
    )
    return write_table(counted, "counted-lines")


def _splits(lines: DataFrame) -> DataFrame:
    """For each split whether it ``starts`` inside quotes, and block and number of the record open at its start."""
    splits = lines.groupBy(*_SPLIT).agg(
        F.sum("quotes").alias("quotes"), F.max("outside").alias("outside"), F.max("inside").alias("inside")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.coalesce(F.sum("quotes").over(before) % 2, F.lit(0)).cast("int")
    placed = splits.withColumn("starts", starts)
    begun = F.when(F.col("starts") == 0, F.col("outside")).otherwise(F.col("inside"))
    opened = F.when(begun > 0, F.struct(F.col("block").alias("block"), begun.alias("record")))
    return placed.select(*_SPLIT, "starts", F.last(opened, ignorenulls=True).over(before).alias("open"))


def read_records(spark: SparkSession, path: str | list[str], *, quote: str = '"') -> DataFrame:
    """(file, first, value): the records of text files, and which is the first of its file.

    A record ends at a line break outside quotes; breaks inside become ``\\n``. Quotes inside a value are
    doubled. Blank records are left out. Runs a job and keeps the lines in the shared folder.
    """
    lines = _counted_lines(spark, path, quote)
    known = join_splittable(lines, write_table(_splits(lines), "csv-splits"), _SPLIT)
    inside = F.col("starts") == 1
    number = F.when(inside, F.col("inside")).otherwise(F.col("outside"))
    begins = (F.col("parity") == 1) == inside
    # Lines before the first record of a split belong to the one open at its start.
    continued = number == 0
    placed = known.select(
        "file",
        F.when(continued, F.col("open.block")).otherwise(F.col("block")).alias("from"),
        F.when(continued, F.col("open.record")).otherwise(number).alias("record"),
        "block", "line", "value",
        (begins & (F.col("quotes") % 2 == 0)).alias("whole"),
    )
    first = (F.col("from") == 0) & (F.col("record") == 1)
    whole = placed.where("whole").select("file", first.alias("first"), "value")
    several = placed.where("NOT whole").groupBy("file", "from", "record")
    parts = F.sort_array(F.collect_list(F.struct("block", "line", "value")))
    joined = several.agg(F.array_join(F.transform(parts, lambda part: part["value"]), "\n").alias("value"))
    records = whole.unionByName(joined.select("file", first.alias("first"), "value"))
    return records.where(F.trim("value") != "")


def read_free_text(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    *,
    header: bool = True,
    quote: str = '"',
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV of a given schema whose values may hold line breaks, whatever the size of a file.

    Values are cast as ``cast_to`` does: what does not fit is NULL. With ``header`` the first record of each file is
    left out; columns go by position. Quotes inside values are doubled, and a value with a quote or line break
    stands in quotes. Runs a job and keeps the lines in the shared folder.
    """
    records = read_records(spark, path, quote=quote)
    if header:
        records = records.where(~F.col("first"))
    text = StructType()
    for field in schema:
        text.add(field.name, StringType())
    parsed = F.from_csv("value", F.lit(text.simpleString()[7:-1].replace(":", " ")), {"quote": quote, "escape": quote, **(options or {})})
    row = records.select(parsed.alias("row"))
    return row.select([cast_to(F.col("row").getField(f.name), f.dataType).alias(f.name) for f in schema])
