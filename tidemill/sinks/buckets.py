"""Keyed tables whose loads and whose compaction cost what the loads bring.

Rows are dealt to buckets by a hash of their key. A load is written as a folder of deltas, one part for
each bucket it touches; ``compact_buckets`` merges and rewrites only the buckets that have deltas. A
version (``tidemill.sinks.versions``) names the parts in force: writing it is the switch, and
all other buckets keep their files, by name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.operators.winners import latest_rows
from tidemill.sinks.versions import current_version, publish_version, read_version
from tidemill.sources.folders import child_names

LOAD = "load_id"
_BUCKET = "key_bucket"
# A base is merged and holds a key once; a delta may hold anything. One entry carries the schema
# and the number of buckets, and one for each load tells that it is in bases.
_ENTRY = "bucket int, kind string, load_id long, path string, detail string"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class _State(NamedTuple):
    version: int
    parts: list
    merged: set[int]
    schema: StructType | None
    buckets: int


def _state(spark: SparkSession, root: str) -> _State:
    version = current_version(spark, root)
    rows = read_version(spark, root, version, _ENTRY).collect()
    parts = [row for row in rows if row.path is not None]
    merged = {row.load_id for row in rows if row.kind == "merged"}
    for row in rows:
        if row.kind == "schema":
            return _State(version, parts, merged, StructType.fromJson(json.loads(row.detail)), row.bucket)
    return _State(version, parts, merged, None, 0)


def _publish(spark: SparkSession, root: str, state: _State) -> int:
    rows = [tuple(part) for part in state.parts] + [(None, "merged", load, None, None) for load in sorted(state.merged)]
    rows.append((state.buckets, "schema", None, None, state.schema.json()))
    publish_version(spark.createDataFrame(rows, _ENTRY), root, state.version)
    return state.version


def _write(rows: DataFrame, root: str, keys: Sequence[str], buckets: int, kind: str) -> dict[int, str]:
    """Write rows by bucket, large ones in several files; bucket and path of each part."""
    folder = f"data/{kind}-{uuid.uuid4().hex}"
    dealt = rows.withColumn(_BUCKET, bucket_of(keys, buckets)).hint("rebalance", F.col(_BUCKET))
    dealt.write.partitionBy(_BUCKET).parquet(f"{root}/{folder}")
    names = child_names(rows.sparkSession, f"{root}/{folder}")
    return {int(name.split("=")[1]): f"{folder}/{name}" for name in names if name.startswith(f"{_BUCKET}=")}


def append_delta(df: DataFrame, root: str, keys: Sequence[str], load_id: int, *, buckets: int = 256) -> int:
    """Add a load and return the new version; the same ``load_id`` again replaces what it brought before.

    The first load fixes columns and number of ``buckets``. A load that has been compacted cannot be
    taken back, so repeating it is refused.
    """
    spark = df.sparkSession
    state = _state(spark, root)
    if load_id in state.merged:
        raise ValueError(f"load {load_id} has been compacted")
    rows = df.withColumn(LOAD, F.lit(load_id).cast("bigint"))
    if state.schema is None:
        state = state._replace(schema=rows.schema, buckets=buckets)
    rows = rows.select([F.col(field.name).cast(field.dataType) for field in state.schema])
    written = _write(rows, root, keys, state.buckets, "delta")
    kept = [part for part in state.parts if part.kind != "delta" or part.load_id != load_id]
    added = [(bucket, "delta", load_id, path, None) for bucket, path in written.items()]
    return _publish(spark, root, state._replace(version=state.version + 1, parts=kept + added))


def _scan(spark: SparkSession, root: str, parts: list, schema: StructType) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{part.path}" for part in parts])


def _open_buckets(parts: list) -> set[int]:
    return {part.bucket for part in parts if part.kind == "delta"}


def read_buckets(spark: SparkSession, root: str, keys: Sequence[str], *, with_load: bool = False) -> DataFrame:
    """The row of the highest load for each key; rows of one load go by ``lost_places``.

    Buckets without deltas are read as they are; only the others are merged. Runs a job if there are any.
    """
    state = _state(spark, root)
    if state.schema is None:
        raise ValueError(f"no complete version below {root}")
    open_ = _open_buckets(state.parts)
    rows = _scan(spark, root, [part for part in state.parts if part.bucket not in open_], state.schema)
    if open_:
        touched = _scan(spark, root, [part for part in state.parts if part.bucket in open_], state.schema)
        rows = rows.unionByName(latest_rows(touched, keys, LOAD))
    return rows if with_load else rows.drop(LOAD)


def compact_buckets(spark: SparkSession, root: str, keys: Sequence[str]) -> int:
    """Merge the buckets that have deltas into new files and return the version in force.

    Rows keep their load, and the files of all other buckets stay in place. Without deltas nothing
    is written.
    """
    state = _state(spark, root)
    open_ = _open_buckets(state.parts)
    if not open_:
        return state.version
    touched = [part for part in state.parts if part.bucket in open_]
    rows = latest_rows(_scan(spark, root, touched, state.schema), keys, LOAD)
    written = _write(rows, root, keys, state.buckets, "base")
    kept = [part for part in state.parts if part.bucket not in open_]
    bases = [(bucket, "base", None, path, None) for bucket, path in written.items()]
    merged = state.merged | {part.load_id for part in touched if part.kind == "delta"}
    return _publish(spark, root, state._replace(version=state.version + 1, parts=kept + bases, merged=merged))


def parts_in_force(spark: SparkSession, root: str) -> dict[int, list[str]]:
    """Paths of each bucket's parts, below ``root``."""
    found: dict[int, list[str]] = {}
    for part in _state(spark, root).parts:
        found.setdefault(part.bucket, []).append(part.path)
    return found
