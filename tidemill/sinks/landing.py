"""Landing tables with one row per key over all loads, and a second path by time.

Rows lie in files by day. Every file has a summary: least and greatest key, and bitmaps of its
keys' hashes, built by Spark's bitmap aggregates. A load compares its own bitmaps with them and
reads only the keys of files that may hold one of its own; files that do hold one are written
anew without those rows, all others stay. A version (``tidemill.sinks.versions``) names the files in force. An
index tells which files hold rows of a second time's day, so a filter on that day opens only those.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.operators.groups import join_splittable
from tidemill.operators.winners import latest_rows, on_files
from tidemill.scratch import write_table
from tidemill.sinks.versions import current_version, publish_version, read_version

# Bits of a file's bitmaps: 2 million, or 8 for each of 256,000 keys; a file has at most 64 bitmaps of 4 kB.
BITS = 1 << 21

_ENTRY = "kind string, path string, detail string"
_SUMMARY = "path string, part long, bits binary, least string, greatest string"
_INDEX = "path string, day date"


def _path_in_table() -> Column:
    return F.concat(F.lit("data/"), F.regexp_extract(F.col("_metadata.file_path"), r"(load=[^/]*/.*)$", 1))


def _position(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BITS))


def _bitmaps(rows: DataFrame, keys: Sequence[str], *by: str) -> DataFrame:
    """Bitmaps of the keys' hashes, and the range of the first key as text, for each of ``by``."""
    position = _position(keys)
    return rows.groupBy(*by, F.bitmap_bucket_number(position).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(position)).alias("bits"),
        F.min(F.col(keys[0]).cast("string")).alias("least"),
        F.max(F.col(keys[0]).cast("string")).alias("greatest"),
    )


def _state(spark: SparkSession, root: str) -> tuple[int, list[str], StructType | None]:
    version = current_version(spark, root)
    rows = read_version(spark, root, version, _ENTRY).collect()
    schema = next((StructType.fromJson(json.loads(row.detail)) for row in rows if row.kind == "schema"), None)
    return version, sorted(row.path for row in rows if row.kind == "file"), schema


def files_in_force(spark: SparkSession, root: str) -> list[str]:
    """Paths of the table's files, below ``root``."""
    return _state(spark, root)[1]


def _scan(spark: SparkSession, root: str, paths: Sequence[str], schema: StructType) -> DataFrame:
    """Rows of some files, with the day from their folder."""
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(StructType([*schema, *StructType().add("load", "string")]))
    return reader.option("basePath", f"{root}/data").parquet(*[f"{root}/{path}" for path in paths]).select(*schema.names)


def _in_force(spark: SparkSession, table: DataFrame, paths: Sequence[str]) -> DataFrame:
    named = write_table(spark.createDataFrame([(path,) for path in paths], "path string"), "files-in-force")
    return table.join(named, "path", "left_semi")


def candidate_files(spark: SparkSession, root: str, rows: DataFrame, keys: Sequence[str]) -> list[str]:
    """Files in force that may hold a key of ``rows``, by their summaries alone."""
    _, paths, _ = _state(spark, root)
    if not paths:
        return []
    summaries = _in_force(spark, spark.read.schema(_SUMMARY).parquet(f"{root}/summaries"), paths)
    wanted = write_table(_bitmaps(rows, keys), "load-bitmaps").select(
        "part", F.col("bits").alias("own"), F.col("least").alias("own_least"), F.col("greatest").alias("own_greatest")
    )
    meeting = (F.col("least") <= F.col("own_greatest")) & (F.col("own_least") <= F.col("greatest"))
    pairs = summaries.join(wanted, "part").where(meeting)
    both = pairs.select("path", "part", F.explode(F.array("bits", "own")).alias("bits")).groupBy("path", "part")
    shared = both.agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("shared")).where("shared > 0")
    return sorted(row.path for row in shared.select("path").distinct().collect())


def _write(spark: SparkSession, rows: DataFrame, root: str, day: str, order: str) -> str:
    name = f"load=l-{uuid.uuid4().hex}"
    dealt = rows.hint("rebalance", F.col(day)).sortWithinPartitions(day, order)
    dealt.write.partitionBy(day).parquet(f"{root}/data/{name}")
    return name


def _describe(spark: SparkSession, root: str, name: str, schema: StructType, keys: Sequence[str], second: str | None) -> list[str]:
    """Write summaries and index of a load's new files, and return the files."""
    names = [*dict.fromkeys([*keys, *([second] if second else [])])]
    rows = spark.read.schema(StructType([schema[n] for n in names])).parquet(f"{root}/data/{name}")
    placed = rows.select(_path_in_table().alias("path"), *names)
    described = _bitmaps(placed, keys, "path")
    described.write.mode("overwrite").parquet(f"{root}/summaries/{name}")
    if second is not None:
        days = placed.select("path", F.col(second).cast("date").alias("day")).distinct()
        days.write.mode("overwrite").parquet(f"{root}/index/{name}")
    found = spark.read.schema(_SUMMARY).parquet(f"{root}/summaries/{name}")
    return [row.path for row in found.select("path").distinct().collect()]


def land(
    rows: DataFrame, root: str, *, keys: Sequence[str], day: str, order: str, second: str | None = None
) -> int:
    """Land a load so that the table holds one row per key, the load's before earlier ones; return the version.

    ``day`` is the column files lie by, ``order`` the order inside them, ``second`` the time of the index.
    Of several rows of a key in the load one stays (``lost_places``). Keys must not be NULL. The first load
    fixes the columns. A load that is lost before its version is written changes nothing.
    """
    spark = rows.sparkSession
    version, files, schema = _state(spark, root)
    schema = schema or rows.schema
    rows = rows.select([F.col(field.name).cast(field.dataType) for field in schema])
    new = write_table(latest_rows(on_files(rows), keys), "landing-load")
    touched: list[str] = []
    possible = candidate_files(spark, root, new, keys)
    if possible:
        mine = new.select(*keys)
        old = _scan(spark, root, possible, schema).select(*keys, _path_in_table().alias("path_in_table"))
        met = join_splittable(old, mine, keys, "left_semi").select("path_in_table").distinct()
        touched = sorted(row.path_in_table for row in met.collect())
    names = [_write(spark, new, root, day, order)]
    if touched:
        stay = join_splittable(_scan(spark, root, touched, schema), new.select(*keys), keys, "left_anti")
        names.append(_write(spark, stay, root, day, order))
    added = [path for name in names for path in _describe(spark, root, name, schema, keys, second)]
    kept = sorted(set(files) - set(touched)) + added
    entries = [("file", path, None) for path in kept] + [("schema", None, schema.json())]
    publish_version(spark.createDataFrame(entries, _ENTRY), root, version + 1)
    return version + 1


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """All rows; filters on the day the files lie by open only those days."""
    _, files, schema = _state(spark, root)
    if schema is None:
        raise ValueError(f"no complete version below {root}")
    return _scan(spark, root, files, schema)


def files_of_days(spark: SparkSession, root: str, first: str, last: str) -> list[str]:
    """Files in force that hold rows of the second time's days ``first`` to ``last``."""
    _, files, _ = _state(spark, root)
    if not files:
        return []
    days = spark.read.schema(_INDEX).parquet(f"{root}/index").where(F.col("day").between(F.lit(first), F.lit(last)))
    return sorted(row.path for row in _in_force(spark, days, files).select("path").distinct().collect())


def read_second_days(spark: SparkSession, root: str, second: str, first: str, last: str) -> DataFrame:
    """Rows whose second time falls on the days ``first`` to ``last``; only files the index names are opened."""
    _, _, schema = _state(spark, root)
    if schema is None:
        raise ValueError(f"no complete version below {root}")
    rows = _scan(spark, root, files_of_days(spark, root, first, last), schema)
    return rows.where(F.col(second).cast("date").between(F.lit(first), F.lit(last)))
