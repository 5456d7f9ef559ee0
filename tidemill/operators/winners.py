"""One row per key of a table kept in files, without sorting or shuffling whole rows.

The rows that lose are found from columns of fixed width: the order, and the place, which is file and
row. Whole rows are compared only where several share the highest order of their key. The places that lose
are then taken out of the scan: where they are few, the other rows are not shuffled at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.groups import join_splittable
from tidemill.scratch import write_table

# Added to rows while they are compared.
_PLACE, _RANK, _TOP, _ROWS = "place_in_files", "rank_in_key", "top_of_key", "rows_of_key"
_ROWS_OF_FILE = 1 << 48
_LOWEST = -(1 << 63)


def place() -> Column:
    """File (as a hash of its path) and row of a Parquet scan as one number, which aggregates keep in place."""
    file = F.xxhash64("_metadata.file_path").cast("decimal(20,0)") * F.lit(Decimal(_ROWS_OF_FILE))
    return (file + F.col("_metadata.row_index").cast("decimal(20,0)")).cast("decimal(38,0)")


def _is_scan(df: DataFrame) -> bool:
    """Whether ``df`` is a scan, filtered and projected only: joins, unions or explodes would repeat places."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias", "View"):
        node = node.children().apply(0)
    return node.children().isEmpty()


def on_files(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` itself if it is a scan of Parquet files, else written below the shared folder and read back."""
    if _is_scan(df):
        try:
            df.select("_metadata.file_path", "_metadata.row_index").schema  # noqa: B018
            return df
        except AnalysisException:
            pass
    return write_table(df, name)


def lost_places(scan: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Places of the rows that are not the last of their key.

    The last has the highest ``order`` (whole numbers; NULL is lowest), then the highest values of the other
    columns in their order; of equal rows any stays. NULL keys are a key. Runs jobs.
    """
    rank = F.coalesce(F.col(order).cast("long"), F.lit(_LOWEST)) if order else F.lit(0).cast("long")
    narrow = scan.select(*keys, rank.alias(_RANK), place().alias(_PLACE))
    tops = narrow.groupBy(*keys).agg(F.max(_RANK).alias(_TOP), F.count("*").alias(_ROWS)).where(F.col(_ROWS) > 1)
    contested = write_table(join_splittable(narrow, tops.drop(_ROWS), keys, null_safe=True), "contested-rows")
    lower = contested.where(F.col(_RANK) < F.col(_TOP)).select(_PLACE)
    highest = contested.where(F.col(_RANK) == F.col(_TOP)).select(*keys, _PLACE)
    several = highest.groupBy(*keys).agg(F.count("*").alias(_ROWS)).where(F.col(_ROWS) > 1)
    tied = write_table(join_splittable(highest, several, keys, null_safe=True).select(_PLACE), "tied-rows")
    if tied.isEmpty():
        return lower
    rows = scan.withColumn(_PLACE, place()).join(tied, _PLACE, "left_semi")
    others = [F.col(f"`{name}`").desc() for name in scan.columns if name not in (*keys, order)]
    # Only the first of a key is asked for, so each task hands on one row of it.
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(*others, _PLACE))
    first = rows.withColumn(_RANK, turn).where(F.col(_RANK) == 1).select(_PLACE)
    return lower.union(tied.join(first, _PLACE, "left_anti"))


def latest_rows(scan: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """The last row of each key by ``order``, as ``lost_places`` says.

    ``scan`` reads Parquet files (``on_files``) and may filter them. Runs jobs: the places are written, so
    that Spark knows their size and broadcasts them only if they are few.
    """
    lost = write_table(lost_places(scan, keys, order), "lost-places")
    return scan.withColumn(_PLACE, place()).join(lost, _PLACE, "left_anti").drop(_PLACE)
