"""Writers: layouts, tables, keyed replacement, landing, options of remote sinks."""

from __future__ import annotations

import datetime as dt
import glob
from unittest.mock import MagicMock, call

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemill import schemas, scratch
from tidemill.plans import comments, loads, serving
from tidemill.sinks import files, kafka, keyed, tables


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_parquet_overwrite(spark, folder):
    files.write_parquet(spark.range(5), folder)
    files.write_parquet(spark.range(2), folder)
    assert spark.read.parquet(folder).count() == 2


def test_text_fails_on_an_existing_path(spark, folder):
    lines = spark.createDataFrame([("a",), ("b",)], "value string")
    files.write_text(lines, folder)
    assert tuples(spark.read.text(folder)) == [("a",), ("b",)]
    with pytest.raises(PySparkException):
        files.write_text(lines, folder)


def file_ranges(folder, column):
    found = []
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        values = pq.read_table(path, columns=[column])[column].to_pylist()
        assert values == sorted(values)
        if values:
            found.append((values[0], values[-1]))
    return found


def test_sorted_layout_orders_files_and_rows(spark, folder):
    spark.range(1000).selectExpr("(id * 37) % 1000 AS k", "id").write.parquet(folder + "-in")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_sorted(spark.read.parquet(folder + "-in"), folder, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranges = sorted(file_ranges(folder, "k"))
    assert len(ranges) > 4
    assert all(first[1] < second[0] for first, second in zip(ranges, ranges[1:]))
    assert spark.read.parquet(folder).count() == 1000


@pytest.mark.parametrize("ties", ["hash", "position"])
def test_sorted_layout_spreads_one_key_over_files(spark, folder, ties):
    spark.range(2000).selectExpr("7 AS k", "id % 100 AS id").write.parquet(folder + "-in")
    rows = spark.read.parquet(folder + "-in")
    spread_by = None if ties == "hash" else [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_sorted(rows, folder, ["k"], spread_by=spread_by)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    written = spark.read.parquet(folder)
    assert written.columns == ["k", "id"] and written.count() == 2000
    assert max(pq.ParquetFile(p).metadata.num_rows for p in glob.glob(f"{folder}/*.parquet")) < 1000


def test_insert_matches_names_not_positions(spark, folder):
    target = spark.createDataFrame([(1, "a")], "id int, name string")
    tables.replace_table(target, "by_name", location=folder)
    tables.insert_into(spark.createDataFrame([("b", 2)], "name string, id int"), "by_name")
    assert tuples(spark.table("by_name")) == [(1, "a"), (2, "b")]
    tables.replace_table(target, "by_name", location=folder)
    assert spark.table("by_name").count() == 1
    spark.sql("DROP TABLE by_name")


def test_loads_append_orders_and_replace_transactions(spark, folder, tmp_path):
    source = tmp_path / "orders.csv"
    source.write_text("order_id;user_id;order_date;total_amount;payment_status\n1;2;2024-01-01 10:00:00;5.50;paid\n")
    empty = spark.createDataFrame([], schemas.ORDERS)
    tables.replace_table(empty, "orders_loaded", location=folder)
    for expected in (1, 2):
        assert loads.load_orders(spark, str(source), "orders_loaded", sep=";").count() == expected
    source = tmp_path / "transactions.csv"
    source.write_text("1,2,5.5,USD,2024-01-01 10:00:00,0\n")
    for _ in range(2):
        loaded = loads.load_transactions(spark, str(source), "transactions_loaded", location=folder + "-t")
        assert tuples(loaded) == [(1, 2, 5.5, "USD", dt.datetime(2024, 1, 1, 10), 0)]
    assert source.exists()
    spark.sql("DROP TABLE orders_loaded")
    spark.sql("DROP TABLE transactions_loaded")


def test_keyed_replacement(spark, folder):
    schema = "k string, n int"
    keyed.append_load(spark.createDataFrame([("a", 1), ("b", 1)], schema), folder, 1)
    serving.replace_aggregates(spark.createDataFrame([("a", 2), ("c", 2)], schema), folder, 2)
    latest = keyed.read_latest(spark, folder, ["k"])
    assert tuples(latest) == [("a", 2), ("b", 1), ("c", 2)] and latest.columns == ["k", "n"]
    keyed.append_load(spark.createDataFrame([("a", 2), ("c", 2)], schema), folder, 2)
    assert tuples(keyed.read_latest(spark, folder, ["k"])) == [("a", 2), ("b", 1), ("c", 2)]
    keyed.append_load(spark.createDataFrame([("a", 10)], schema), folder, 10)
    keyed.compact(spark, folder, folder + "-new", ["k"], 10)
    assert tuples(keyed.read_loads(spark, folder + "-new").drop("load_id")) == [("a", 10), ("b", 1), ("c", 2)]
    assert tuples(keyed.read_latest(spark, folder + "-new", ["k"])) == [("a", 10), ("b", 1), ("c", 2)]


def test_switching_to_a_new_version(spark, folder):
    schema = "k string, n int"
    tables.replace_table(spark.createDataFrame([("a", 1)], schema), "served", location=folder + "-v1")
    keyed.append_load(spark.createDataFrame([("a", 1)], schema), folder, 1)
    keyed.append_load(spark.createDataFrame([("a", 2), ("b", 2)], schema), folder, 2)
    keyed.compact(spark, folder, folder + "-v2", ["k"], 2)
    assert tuples(spark.table("served")) == [("a", 1)]
    tables.switch_location(spark, "served", folder + "-v2/load_id=2")
    assert tuples(spark.table("served")) == [("a", 2), ("b", 2)]
    spark.sql("DROP TABLE served")


def test_landing_keeps_one_row_per_key_by_day(spark, folder):
    raw = spark.createDataFrame(
        [
            ("a", "p", "2024-01-01 23:59:59", "2024-01-01 00:00:00", "x"),
            ("a", "p", "2024-01-01 23:59:59", "2024-01-01 00:00:00", "y"),
            ("b", "p", "2024-01-02 00:00:00", "2024-01-01 00:00:00", "z"),
            ("c", "p", "no time", None, "z"),
            (None, "p", "2024-01-02 00:00:00", None, "z"),
            ("d", None, "2024-01-02 00:00:00", None, "z"),
        ],
        "comment_id string, post_id string, created_time string, post_created_time string, t string",
    )
    rejects = comments.land_raw_comments(raw, folder)
    assert rejects.count() == 2
    landed = spark.read.parquet(folder)
    assert tuples(landed.select("comment_id", "t", "created_time_day")) == [
        ("a", "y", dt.date(2024, 1, 1)),
        ("b", "z", dt.date(2024, 1, 2)),
        ("c", "z", None),
    ]
    plan = landed.where("created_time_day = DATE'2024-01-02'")
    assert "PartitionFilters: [isnotnull(created_time_day" in plan._jdf.queryExecution().executedPlan().toString()


BROKERS = {"kafka.bootstrap.servers": "broker:9092"}


def test_kafka_publish_goes_through_the_built_in_writer():
    df = MagicMock()
    kafka.publish(df, BROKERS, "topic")
    df.select.assert_called_once_with("value")
    writer = df.select().write.format
    writer.assert_called_once_with("kafka")
    writer().options.assert_called_once_with(**BROKERS, topic="topic")
    writer().options().save.assert_called_once_with()


def test_kafka_publish_without_connector_fails(spark):
    with pytest.raises(PySparkException):
        comments.publish_json(spark.createDataFrame([("m",)], schemas.MESSAGE), BROKERS, "topic")


def test_partition_status_adds_up(spark):
    status = kafka.partition_status(spark.range(0, 100, 1, 4).selectExpr("CAST(id AS STRING) AS value"))
    assert [row.records for row in status.collect()] == [25, 25, 25, 25]


def test_jdbc_batches_tag_and_append():
    batch = MagicMock()
    tagged = batch.withColumn.return_value
    connection = {"url": "jdbc:example:db"}
    tables.jdbc_batches(connection, "target", connections=4)(batch, 7)
    assert batch.withColumn.call_args.args[0] == "batch_id"
    assert tagged.write.format.call_args == call("jdbc")
    tagged.write.format().options.assert_called_once_with(
        url="jdbc:example:db", dbtable="target", numPartitions="4", batchsize="10000"
    )
    tagged.write.format().options().mode.assert_called_once_with("append")
    tagged.write.format().options().mode().save.assert_called_once_with()


def test_scratch_uses_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch.new_path(spark, "x")
    assert path != scratch.new_path(spark, "x")
    if named:
        assert path.startswith(named.rstrip("/") + "/")


def test_scratch_releases_only_what_it_wrote(spark, folder, monkeypatch):
    monkeypatch.setattr(scratch, "_handed_out", {})
    monkeypatch.setattr(scratch, "shared_folder", lambda session: folder)
    spark.range(3).write.parquet(folder + "/tidemill/other")
    written = scratch.write_table(spark.range(3), "mine")
    assert written.count() == 3
    assert scratch.release(spark) == 1
    assert glob.glob(folder + "/tidemill/*") == [folder + "/tidemill/other"]
    assert scratch.release(spark) == 0


def test_scratch_needs_a_shared_folder_on_a_cluster():
    session = MagicMock()
    session.conf.get.return_value = None
    session.sparkContext.getCheckpointDir.return_value = None
    session.sparkContext.master = "yarn"
    with pytest.raises(ValueError):
        scratch.shared_folder(session)
    session.sparkContext.master = "local[2]"
    session.sparkContext.applicationId = "app"
    assert scratch.shared_folder(session) == scratch.shared_folder(session)
