"""The test tables under the names and types the plans expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.schemas import layout


LAYOUTS = {
    "region": layout(r_regionkey="integer", r_name="string"),
    "nation": layout(n_nationkey="integer", n_name="string", n_regionkey="integer"),
    "customer": layout(
        c_custkey="long",
        c_name="string",
        c_nationkey="integer",
        c_acctbal="double",
        c_mktsegment="string",
    ),
    "supplier": layout(s_suppkey="long", s_name="string", s_nationkey="integer", s_acctbal="double"),
    "part": layout(
        p_partkey="long",
        p_name="string",
        p_brand="string",
        p_type="string",
        p_size="integer",
        p_retailprice="double",
    ),
    "orders": layout(
        o_orderkey="long",
        o_custkey="long",
        o_orderstatus="string",
        o_totalprice="double",
        o_orderdate="timestamp_ntz",
        o_orderpriority="string",
    ),
    "lineitem": layout(
        l_orderkey="long",
        l_partkey="long",
        l_suppkey="long",
        l_linenumber="integer",
        l_quantity="double",
        l_extendedprice="double",
        l_discount="double",
        l_tax="double",
        l_returnflag="string",
        l_linestatus="string",
        l_shipdate="timestamp_ntz",
    ),
    "events": layout(
        event_id="long",
        ts="timestamp_ntz",
        user_id="long",
        event_type="string",
        value="double",
        props="string",
    ),
    "documents": layout(doc_id="long", text="string", lang="string", source="string", n_chars="long"),
    "conversations": layout(conv_id="long", turn="long", role="string", text="string"),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table, its layout given so that no job is needed to infer it."""
    return spark.read.schema(LAYOUTS[name]).parquet(f"{folder}/{name}.parquet")


def money(name: str) -> Column:
    """Amounts have two decimals; as decimals their sums do not depend on row order."""
    return F.col(name).cast("decimal(12,2)")


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        money("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("currency"),
        F.col("o_orderdate").alias("transaction_date"),
        (F.col("o_orderstatus") == "F").cast("int").alias("is_fraud"),
    )


def logs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_returnflag").alias("category"),
        F.col("l_shipdate").alias("logtimestamp"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_date"),
        money("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("payment_status"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        money("l_extendedprice").alias("product_price"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def named_order_items(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("product_name")
    )
    return order_items(spark, folder).join(parts, "product_id")
