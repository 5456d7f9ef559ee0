"""Readers: headers, separators, odd spellings, ragged documents, options of remote sources."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal
from unittest.mock import MagicMock

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.functions.casts import parse_amount, parse_utc_ts
from tidemill.sources import files, streams, tables


def lines(tmp_path, name, *content):
    path = tmp_path / name
    path.write_text("\n".join(content) + "\n", encoding="utf-8")
    return str(path)


def tuples(df):
    return [tuple(row) for row in df.collect()]


def test_csv_with_header_as_text_or_inferred(spark, tmp_path):
    path = lines(tmp_path, "a.csv", "id,name", "1,x", "2,")
    assert files.read_csv(spark, path).dtypes == [("id", "string"), ("name", "string")]
    inferred = files.read_csv(spark, path, infer=True)
    assert inferred.dtypes == [("id", "int"), ("name", "string")]
    assert tuples(inferred) == [(1, "x"), (2, None)]


def test_free_text_keeps_line_breaks_and_quotes(spark, tmp_path):
    path = lines(tmp_path, "a.csv", "id,text", '1,"two', 'lines, ""quoted"""', "2,plain")
    assert tuples(files.read_csv(spark, path)) == [("1", 'two\nlines, "quoted"'), ("2", "plain")]


def test_comma_text_with_schema(spark, tmp_path):
    path = lines(
        tmp_path,
        "t.csv",
        "1,7,10.5,USD,2024-01-01 23:59:00,0",
        "2,8,bad,EUR,2024-01-02 00:00:00,1,extra",
        "3,9,1.0",
    )
    assert tuples(files.read_delimited(spark, path, schemas.TRANSACTIONS)) == [
        (1, 7, 10.5, "USD", dt.datetime(2024, 1, 1, 23, 59), 0),
        (2, 8, None, "EUR", dt.datetime(2024, 1, 2), 1),
        (3, 9, 1.0, None, None, None),
    ]


def test_semicolon_text_with_schema(spark, tmp_path):
    path = lines(tmp_path, "l.txt", "1;5;food;a, b;2024-01-01 10:00:00")
    assert tuples(files.read_delimited(spark, path, schemas.LOGS, sep=";")) == [
        (1, 5, "food", "a, b", dt.datetime(2024, 1, 1, 10))
    ]


@pytest.mark.parametrize("sep", [",", ";"])
def test_csv_with_names(spark, tmp_path, sep):
    path = lines(
        tmp_path,
        "i.csv",
        sep.join(("item_id", "order_id", "product_name", "product_price", "quantity")),
        sep.join(("1", "10", "pen", "1.50", "2")),
    )
    assert tuples(files.read_delimited(spark, path, schemas.ORDER_ITEMS, sep=sep, header=True)) == [
        (1, 10, "pen", Decimal("1.50"), 2)
    ]


def test_headerless_file_with_odd_spellings(spark, tmp_path):
    path = lines(
        tmp_path,
        "p.csv",
        "1,Ann,F,40905e-3,1987-11-30 06:45:10 +0000 UTC",
        "2,Bob,M,-7e1,",
        "3,Cy,M,n/a,yesterday",
    )
    people = files.read_delimited(spark, path, schemas.PEOPLE)
    parsed = people.select("id", parse_amount(F.col("amount")), parse_utc_ts(F.col("born")))
    assert tuples(parsed) == [
        (1, Decimal("40.91"), dt.datetime(1987, 11, 30, 6, 45, 10)),
        (2, Decimal("-70.00"), None),
        (3, None, None),
    ]


def test_ragged_document(spark, tmp_path):
    """A library of shelves, their books and the books' loans; every level lacks keys somewhere."""
    document = {
        "city": "Harbour",
        "shelves": [
            {"code": "N", "books": [{"isbn": 11, "loans": [3, 5, 8]}, {"isbn": 12, "title": "Tides"}]},
            {"code": "E", "height": 2.1},
            {"books": [{"title": "Charts", "loans": []}]},
            {"code": "W", "books": []},
            {"code": "S", "books": [{"isbn": 13, "loans": [1]}, {"isbn": 14}, {"loans": [2, 2]}]},
        ],
    }
    path = tmp_path / "d.json"
    path.write_text(json.dumps(document, indent=1))
    given = "city string, shelves array<struct<code:string,height:double,books:array<struct<isbn:bigint,loans:array<bigint>,title:string>>>>"
    for schema in (None, given):
        read = files.read_json_doc(spark, str(path), schema=schema)
        shelves = read.select("city", F.explode("shelves").alias("s")).select("city", "s.*")
        books = shelves.select("code", F.explode_outer("books").alias("b")).select("code", "b.*")
        loans = books.select("isbn", F.explode("loans").alias("day"))
        assert shelves.count() == 5 and shelves.where("height IS NULL").count() == 4
        assert books.count() == 8 and books.where("isbn IS NULL").count() == 4
        assert [row.day for row in loans.orderBy("day").collect()] == [1, 2, 2, 3, 5, 8]


def test_user_documents_keep_missing_keys(spark, tmp_path):
    path = tmp_path / "u.json"
    path.write_text(json.dumps({"users": [{"name": "Zoe"}, {"id": 70, "logins": ["m"]}]}))
    read = files.read_json_doc(spark, str(path), schema=schemas.USER_DOCUMENT)
    users = read.select(F.explode("users").alias("u")).select("u.id", "u.name", "u.logins")
    assert tuples(users) == [(None, "Zoe", None), (70, None, ["m"])]
    assert read.first().transactions is None


def test_parquet_reads_only_what_is_selected(spark, folder):
    spark.range(10).selectExpr("id", "id * 2 AS twice", "'x' AS text").write.parquet(folder)
    plan = files.read_parquet(spark, folder).where("id = 3").select("twice")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,twice:bigint>" in text and "EqualTo(id,3)" in text
    assert tuples(plan) == [(6,)]


def test_inline_rows(spark):
    messages = spark.createDataFrame([Row(msg="first"), Row(msg="second")])
    assert messages.schema == schemas.MESSAGE and messages.count() == 2


def test_catalog_table(spark):
    spark.range(3).createOrReplaceTempView("three_rows")
    assert tables.read_table(spark, "three_rows").count() == 3


CONNECTION = {"url": "jdbc:example:db", "user": "reader", "driver": "org.example.Driver"}


def test_jdbc_query_becomes_a_partitioned_derived_table():
    options = tables.jdbc_options(
        CONNECTION, "SELECT id FROM t;\n", partition_column="id", bounds=(0, 999), partitions=4
    )
    assert options == {
        **CONNECTION,
        "dbtable": "(SELECT id FROM t) source_rows",
        "fetchsize": "10000",
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "999",
        "numPartitions": "4",
    }
    assert "partitionColumn" not in tables.jdbc_options(CONNECTION, "SELECT 1", partitions=1)
    for incomplete in ({"partition_column": "id"}, {"bounds": (0, 9)}):
        with pytest.raises(ValueError):
            tables.jdbc_options(CONNECTION, "SELECT 1", partitions=4, **incomplete)


def test_jdbc_reader_gets_the_options():
    session = MagicMock()
    tables.read_jdbc(session, CONNECTION, "SELECT 1", partitions=1)
    session.read.format.assert_called_once_with("jdbc")
    session.read.format().options.assert_called_once_with(
        **tables.jdbc_options(CONNECTION, "SELECT 1", partitions=1)
    )


BROKERS = {"kafka.bootstrap.servers": "broker:9092", "kafka.security.protocol": "SASL_SSL"}


@pytest.mark.parametrize("starting", ["earliest", "latest"])
def test_kafka_subscription(starting):
    session = MagicMock()
    streams.kafka_source(session, BROKERS, "topic", starting=starting, max_offsets=100, min_partitions=64)
    session.readStream.format.assert_called_once_with("kafka")
    session.readStream.format().options.assert_called_once_with(
        **BROKERS,
        subscribe="topic",
        startingOffsets=starting,
        maxOffsetsPerTrigger="100",
        minPartitions="64",
    )


def test_kafka_start_is_checked():
    with pytest.raises(ValueError):
        streams.kafka_source_options(BROKERS, "topic", starting="middle", max_offsets=1)
