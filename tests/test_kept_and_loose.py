"""Reports from states, ledgers, statuses of written records, loose records, balanced ranges."""

from __future__ import annotations

import datetime as dt
from unittest.mock import MagicMock

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.functions.records import encode_rows, times_as_text
from tidemill.operators import states
from tidemill.plans import kept, transactions
from tidemill.sinks import keyed, status, tables
from tidemill.sinks.files import write_text
from tidemill.sources.ranges import quantile_cuts, range_predicates, rows_of_days
from tidemill.sources.streams import folder_source
from tidemill.sources.tables import read_jdbc_ranges
from tidemill.streaming import ledger, loose
from tidemill.streaming.decode import decode_records
from tidemill.streaming.runs import start_batches


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def deals(spark, start, rows):
    made = [(n, dt.datetime(2024, 1, 1 + n % 5, 10), None if n % 11 == 0 else n) for n in range(start, start + rows)]
    typed = spark.createDataFrame(made, "transaction_id long, transaction_date timestamp, amount int")
    return typed.withColumn("amount", (F.col("amount") / 4).cast("decimal(12,2)"))


def test_daily_report_from_states_of_loads(spark, folder):
    loads = [deals(spark, 0, 40), deals(spark, 40, 7), deals(spark, 47, 33), deals(spark, 0, 0)]
    kept.add_days(loads[0], folder, 1)
    kept.add_days(loads[2], folder, 2)  # replaced by the right load
    for load_id, rows in enumerate(loads[1:], 2):
        kept.add_days(rows, folder, load_id)
    whole = transactions.daily_transactions(loads[0].union(loads[1]).union(loads[2]))
    typed = whole.withColumn("total_amount", F.col("total_amount").cast("decimal(38,2)"))
    assert tuples(kept.daily_transactions(spark, folder)) == tuples(typed)
    kept.fold_days(spark, folder, folder + "-folded", 1)
    assert keyed.read_loads(spark, folder + "-folded").count() == 5
    assert tuples(kept.daily_transactions(spark, folder + "-folded")) == tuples(typed)


def test_a_key_without_values_has_no_average(spark):
    rows = spark.createDataFrame([("a", None), ("b", 2)], "k string, v int")
    found = states.finish_sums(states.sum_state(rows, ["k"], "v"), ["k"], count="n", total="t", mean="m")
    assert {row.k: (row.n, row.m) for row in found.collect()} == {"a": (1, None), "b": (1, 2.0)}


def test_distinct_numbers_from_states(spark, folder):
    numbers = [1, 1, 2, 32_767, 32_768, 32_769, 70_000, -5, 0, None]
    rows = spark.createDataFrame([(k, n) for k in ("a", None) for n in numbers], "category string, transaction_id long")
    for load_id, part in enumerate((rows, rows.where("transaction_id > 5"), rows.where("false")), 1):
        kept.add_category_transactions(part, folder, load_id)
    assert tuples(kept.category_transactions(spark, folder)) == [("a", 8), (None, 8)]
    kept.fold_category_transactions(spark, folder, folder + "-folded", 9)
    assert tuples(kept.category_transactions(spark, folder + "-folded")) == [("a", 8), (None, 8)]


def test_states_of_repeated_micro_batches(spark, folder):
    deals(spark, 0, 60).repartition(4).write.parquet(folder + "-in")
    rows = folder_source(spark, folder + "-in", "parquet", schema=deals(spark, 0, 1).schema, max_files=1)
    write = kept.day_batches(folder)

    def write_twice(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)

    start_batches(rows, write_twice, folder + "-c", available_now=True).awaitTermination()
    found = kept.daily_transactions(spark, folder).select("transaction_date", "transactions_count")
    assert tuples(found) == tuples(deals(spark, 0, 60).groupBy(F.to_date("transaction_date")).count())


EVENT = schemas.layout(id="long", at="timestamp", name="string")


def records(spark, path, rows=60):
    at = dt.datetime(2024, 1, 1, 10, 0, 0, 250_000)
    made = spark.createDataFrame([(n, at + dt.timedelta(microseconds=n), f"n{n}") for n in range(rows)], EVENT)
    write_text(encode_rows(times_as_text(made)).repartition(6), path)
    return made


def test_a_crash_between_rows_and_ledger_counts_every_row_once(spark, folder):
    made = records(spark, folder + "-topic")
    append, calls = ledger.append_to_folder(folder + "/staged"), []

    def append_and_crash(rows):
        append(rows)
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("crash")

    def run():
        stream = decode_records(folder_source(spark, folder + "-topic", "text", max_files=2), EVENT)
        write = ledger.ledger_batches(append_and_crash, folder + "/ledger", "comments")
        return start_batches(stream, write, folder + "-c", available_now=True)

    with pytest.raises(StreamingQueryException):
        run().awaitTermination()
    staged = spark.read.parquet(folder + "/staged")
    assert staged.count() == 40 and ledger.committed_rows(staged, folder + "/ledger").count() == 20
    run().awaitTermination()
    staged = spark.read.parquet(folder + "/staged")
    assert staged.count() == 80
    assert tuples(ledger.committed_rows(staged, folder + "/ledger")) == tuples(made)
    assert [(row.batch_id, row.rows) for row in ledger.abandoned_attempts(staged, folder + "/ledger").collect()] == [(1, 20)]


def test_ledger_of_an_appended_catalog_table(spark, folder):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    empty = rows.where("false").selectExpr("*", "'' AS stream", "0L AS batch_id", "'' AS attempt")
    tables.replace_table(empty, "appended", location=folder)
    write = ledger.ledger_batches(lambda batch: tables.insert_into(batch, "appended"), folder + "-ledger", "s")
    for batch_id in (0, 0, 1):
        write(rows, batch_id)
    ledger.commit(spark, folder + "-ledger", "s", 0, "zzz")  # a second row of a batch, of a later attempt
    other = ledger.ledger_batches(lambda batch: tables.insert_into(batch, "appended"), folder + "-ledger", "other")
    other(rows, 0)
    assert spark.table("appended").count() == 6
    assert ledger.committed_rows(spark.table("appended"), folder + "-ledger").count() == 6
    spark.sql("DROP TABLE appended")


def test_status_comes_from_the_writing(spark, folder):
    rows = spark.range(100).selectExpr("CAST(id AS STRING) AS value", "IF(id < 30, 'a', 'b c') AS topic").repartition(3)
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    observed = status.publish_to_folder(rows.mapInArrow(count, rows.schema), folder)
    assert observed == {"records": 100, "bytes": 190} and reads.value == 100
    written = status.confirm(spark, folder, observed)
    assert written.count() <= 6 and {row.partition for row in written.collect()} == {0, 1, 2}
    assert tuples(written.groupBy("topic").agg(F.sum("records"))) == [("a", 30), ("b c", 70)]
    with pytest.raises(ValueError, match="101 records were sent and 100"):
        status.confirm(spark, folder, {"records": 101, "bytes": 0})


def test_status_of_nothing(spark, folder):
    nothing = spark.range(0).selectExpr("CAST(id AS STRING) AS value", "'a' AS topic")
    observed = status.publish_to_folder(nothing, folder)
    assert observed["records"] == 0 and status.confirm(spark, folder, observed).count() == 0


LOOSE = schemas.layout(id="integer", v="double", t="timestamp")
ODD = [
    '{"id":1,"v":1.5,"t":"2024-01-01 10:00:00.5"}', '{"id":"2","v":"7","t":null}', '{"id":3,"v":"n/a"}',
    '{"id":4,"v":{"a":1},"t":5}', "bad", None, "[1]", '{"id":99999999999999,"v":[1],"t":"soon"}', "",
]


def test_loose_records_keep_values_and_reasons(spark):
    rows = spark.createDataFrame([(text,) for text in ODD], "value string")
    found = loose.typed_fields(rows, LOOSE).select("id", "v", "t", loose.REASONS)
    none = {name: "no record" for name in ("id", "v", "t")}
    wanted = [
        (1, 1.5, dt.datetime(2024, 1, 1, 10, 0, 0, 500_000), {}), (2, 7.0, None, {"t": "null"}),
        (3, None, None, {"v": "string", "t": "missing"}), (4, None, None, {"v": "object", "t": "number"}),
        (None, None, None, none), (None, None, None, none), (None, None, None, dict.fromkeys(none, "missing")),
        (None, None, None, {"id": "number", "v": "array", "t": "string"}), (None, None, None, none),
    ]
    assert tuples(found) == sorted(wanted, key=repr)
    assert "\"a\":1" in loose.typed_fields(rows, LOOSE).where("id = 4").selectExpr("to_json(record) AS j").first().j


def test_types_that_drift_are_counted(spark):
    rows = spark.createDataFrame([(text,) for text in ODD], "value string")
    counts = {(row.field, row.kind): row.records for row in loose.field_types(rows, LOOSE).collect()}
    assert counts["id", "number"] == 4 and counts["id", "string"] == 1
    assert counts["v", "object"] == counts["v", "array"] == 1 and counts["v", "missing"] == 1
    same = spark.createDataFrame([('{"a":1,"b":"x"}',), ('{"a":2,"b":3}',)], "value string")
    assert loose.common_schema(same) == "OBJECT<a: BIGINT, b: VARIANT>"


@pytest.mark.parametrize("key", ["pow(id, 4)", "CASE WHEN id % 5 > 0 THEN id END", "CASE WHEN id < 400 THEN 7L ELSE id END"])
def test_every_row_meets_one_range(spark, key):
    rows = spark.range(1000).selectExpr("id", f"CAST({key} AS BIGINT) AS k")
    conditions = range_predicates("k", quantile_cuts(rows, "k", 10))
    assert len(conditions) <= 11
    met = rows.select(sum(F.when(F.expr(c), 1).otherwise(0) for c in conditions).alias("n"))
    assert tuples(met.distinct()) == [(1,)]
    if "400" not in key:  # one value cannot be cut
        sizes = [rows.where(c).count() for c in conditions[:-1]]
        assert max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_ranges_of_other_kinds(spark):
    rows = spark.range(100).selectExpr(
        "date_add(DATE'2024-01-01', CAST(id AS INT)) AS d", "CAST(id AS DECIMAL(9,2)) / 3 AS m",
        "timestamp_millis(id * 1001) AS t", "IF(id = 5, DOUBLE('NaN'), id / 7) AS f", "CAST(NULL AS INT) AS e",
    )
    for name in rows.columns:
        conditions = range_predicates(name, quantile_cuts(rows, name, 4))
        assert sum(rows.where(c).count() for c in conditions) == 100
        assert len(conditions) == (5 if name != "e" else 2)
    assert range_predicates("s", ["it's"])[0] == "s < 'it''s'"


def test_ranges_go_to_the_database_reader():
    session = MagicMock()
    read_jdbc_ranges(session, {"url": "jdbc:example:db", "user": "u"}, "SELECT 1;", ["a < 1", "a >= 1"])
    session.read.jdbc.assert_called_once_with(
        "jdbc:example:db", "(SELECT 1) source_rows", predicates=["a < 1", "a >= 1"], properties={"user": "u", "fetchsize": "10000"}
    )


def test_only_named_days_are_opened(spark, folder):
    spark.range(300).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 30 AS INT)) AS day").write.partitionBy("day").parquet(folder)
    spark.range(30).selectExpr("date_add(DATE'2024-01-01', CAST(id AS INT)) AS day", "id % 10 AS kind").write.parquet(folder + "-days")
    fact, days = spark.read.parquet(folder), spark.read.parquet(folder + "-days").where("kind = 3")
    found = rows_of_days(fact.withColumn("file", F.col("_metadata.file_path")), days, "day")
    assert found.count() == 30
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    days_read = {row.file.split("day=")[1][:10] for row in found.select("file").distinct().collect()}
    assert days_read == {"2024-01-04", "2024-01-14", "2024-01-24"}
