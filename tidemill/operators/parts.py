"""Groups cut into parts of a given size, in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.groups import join_splittable
from tidemill.scratch import write_table

# Elements of a part, unless the caller's documents need another layout.
PART_SIZE = 10_000

# Added to rows while they are placed.
_ROWS, _SLICE, _AT, _SHIFT = "rows_of_group", "slice_of_rows", "row_in_slices", "shift_to_place"


def in_parts(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], part_size: int = PART_SIZE
) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``part``, and a table of those ``keys`` that have several, with ``parts``.

    A row's part is its place in its key by ``order``, from 0, divided by ``part_size``; one rule
    for every key, and the parts one after the other are the key in order. Keys of one part,
    nearly all of them as a rule, need no places: only keys with more rows are sorted, and over tasks, so
    that no task sorts a large key alone. Of rows equal in ``order`` any may come first. Runs jobs, and keeps
    the large keys and their rows in the shared folder.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias(_ROWS)).where(F.col(_ROWS) > part_size)
    large = write_table(counts, "large-groups")
    parts = large.select(*keys, F.ceil(F.col(_ROWS) / part_size).cast("int").alias("parts"))
    if large.isEmpty():
        return rows.withColumn("part", F.lit(0)), parts
    marked = join_splittable(rows, large, keys, "left", null_safe=True)
    small = marked.where(F.col(_ROWS).isNull()).drop(_ROWS).withColumn("part", F.lit(0))
    several = write_table(marked.where(F.col(_ROWS).isNotNull()).drop(_ROWS), "rows-of-large-groups")
    return small.unionByName(_placed(several, keys, order, part_size)), parts


def _placed(rows: DataFrame, keys: Sequence[str], order: Sequence[str], part_size: int) -> DataFrame:
    """``rows`` with ``part``, by one range shuffle: a slice holds a stretch of the sorted rows, which it numbers."""
    ordered = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    numbered = ordered.withColumn(_SLICE, F.spark_partition_id()).withColumn(_AT, F.monotonically_increasing_id())
    sliced = write_table(numbered, "sliced-rows")
    in_key = Window.partitionBy(*keys).orderBy(_SLICE)
    starts = sliced.groupBy(*keys, _SLICE).agg(F.min(_AT).alias(_AT), F.count("*").alias(_ROWS))
    before = F.sum(_ROWS).over(in_key) - F.col(_ROWS)
    shifts = write_table(starts.select(*keys, _SLICE, (before - F.col(_AT)).alias(_SHIFT)), "slice-shifts")
    shifted = join_splittable(sliced, shifts, [*keys, _SLICE], null_safe=True)
    part = F.floor((F.col(_AT) + F.col(_SHIFT)) / part_size).cast("int")
    return shifted.withColumn("part", part).drop(_SLICE, _AT, _SHIFT)


def owners_of_parts(owners: DataFrame, parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A row of ``owners`` for each of its parts, with ``part`` and ``parts``; those not in ``parts`` have one."""
    known = F.coalesce(F.col("parts"), F.lit(1))
    numbers: Column = F.explode(F.sequence(F.lit(0), known - 1)).alias("part")
    return owners.join(parts, list(keys), "left").select(*owners.columns, known.alias("parts"), numbers)
