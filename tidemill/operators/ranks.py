"""Dense ranks over partitions of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.groups import join_splittable
from tidemill.scratch import write_table


def dense_ranks(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: str,
    *,
    ascending: str = "rank_ascending",
    descending: str = "rank_descending",
) -> DataFrame:
    """Both dense ranks of each distinct value of ``order_by`` within its partition.

    A plain window sorts a whole partition in one task. Here the distinct values are range
    partitioned on (partition, value), so a large partition covers several slices in order;
    a rank is the position inside the slice plus the values in the slices before it.
    The slices are written once, as their limits come from a sample; so are the few offsets,
    which lets Spark see that they are small enough to broadcast.
    """
    values = df.select(*partition_by, order_by).distinct()
    sliced = write_table(
        values.repartitionByRange(*partition_by, order_by).withColumn("slice", F.spark_partition_id()),
        "ranked-values",
    )
    in_order = Window.partitionBy(*partition_by).orderBy("slice")
    slices = (
        sliced.groupBy(*partition_by, "slice")
        .agg(F.count(F.lit(1)).alias("values_in_slice"))
        .select(
            *partition_by,
            "slice",
            (F.sum("values_in_slice").over(in_order) - F.col("values_in_slice")).alias("values_before"),
            F.sum("values_in_slice").over(Window.partitionBy(*partition_by)).alias("values_total"),
        )
    )
    inside = Window.partitionBy(*partition_by, "slice").orderBy(order_by)
    positioned = sliced.withColumn("position", F.row_number().over(inside))
    rank = F.col("values_before") + F.col("position")
    offsets = write_table(slices, "slice-offsets")
    ranked = join_splittable(positioned, offsets, [*partition_by, "slice"], null_safe=True)
    return ranked.select(
        *partition_by,
        order_by,
        rank.alias(ascending),
        (F.col("values_total") + 1 - rank).alias(descending),
    )
