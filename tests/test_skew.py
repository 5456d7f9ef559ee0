"""One key holding a third of the rows: joins are split, results stay whole."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tidemill.operators.groups import join_splittable, partition_average
from tidemill.operators.parts import in_parts
from tidemill.plans import orders

SMALL_SCALE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k",
}


@contextmanager
def settings(spark, values):
    """Thresholds scaled down, so that a small test takes the path of a large one."""
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in values:
            spark.conf.unset(name)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """60,000 items over 20,001 orders; order 7 has a third of them."""
    return spark.range(0, 60000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20000).alias("order_id"),
        F.concat(F.lit("p"), F.col("id") % 50).alias("product_name"),
        (F.col("id") % 97).cast("decimal(12,2)").alias("product_price"),
        (F.col("id") % 5).cast("int").alias("quantity"),
    )


def test_join_with_an_aggregate_is_split(spark, skewed):
    counts = skewed.groupBy("order_id").count()
    with settings(spark, SMALL_SCALE):
        plain = final_plan(skewed.join(counts, "order_id"))
        ours = join_splittable(skewed, counts, ["order_id"])
        text = final_plan(ours)
        assert ours.count() == 60000
    assert "skew=true" not in plain, "Spark now splits this join by itself"
    assert "skew=true" in text


@pytest.mark.parametrize("report", ["sales", "average"])
def test_reports_split_the_hot_order_and_agree(spark, skewed, report):
    bought = skewed.select("order_id").distinct().where("order_id % 2 = 1")

    def run():
        if report == "sales":
            return orders.product_sales(bought, skewed)
        return partition_average(skewed, ["order_id"], "product_price", "mean")

    expected = sorted(map(tuple, run().collect()))
    with settings(spark, SMALL_SCALE):
        df = run()
        assert "skew=true" in final_plan(df)
        assert sorted(map(tuple, df.collect())) == expected


def test_large_groups_are_cut_in_order(spark, skewed):
    rows = skewed.withColumn("item", F.monotonically_increasing_id())
    placed, _ = in_parts(rows, ["order_id"], ["item"], part_size=500)
    sizes = placed.groupBy("order_id", "part").count().collect()
    assert sum(row["count"] for row in sizes) == 60000
    assert {row["count"] for row in sizes if row.order_id == 7 and row.part < 39} == {500}
    assert {row.part for row in sizes if row.order_id != 7} == {0}
