"""Casts, nulls, duplicates, rejects, JSON records and result normalization."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType, TimestampNTZType, TimestampType

from tidemill import schemas
from tidemill.functions import casts, labels, records
from tidemill.operators import clean
from tidemill.operators.groups import keep_latest
from tidemill.plans import comments, serving
from tidemill.streaming.decode import decode_records


def tuples(df):
    return [tuple(row) for row in df.collect()]


def one_column(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "x string")


def cast(spark, data_type, *values):
    field = schemas.layout(x=data_type)["x"].dataType
    return [row.x for row in one_column(spark, *values).select(casts.cast_to(F.col("x"), field).alias("x")).collect()]


def test_casts_give_null_where_the_text_does_not_fit(spark):
    assert cast(spark, "integer", "7", "7.9", "1e3", "x", None, "99999999999") == [7, 7, 1000, None, None, None]
    assert cast(spark, "integer", "-7.9", ".5", "5.", " 8 ", "12d", "0x1", "NaN", "") == [
        -7, 0, 5, 8, None, None, None, None
    ]
    big = 2**62 + 1
    assert cast(spark, "long", str(big), f"{big}.7", "1e3", "1e30", "12.0") == [big, big, 1000, None, 12]
    assert cast(spark, "float", "0.5", "x", None) == [0.5, None, None]
    assert cast(spark, "boolean", "True", " false ", "Y", "0", "maybe", "11", "", None) == [
        True, False, True, False, None, None, None, None
    ]
    assert cast(spark, "timestamp", "2022-09-12 10:18:52", "2022-09-12T10:18:52Z", "") == [
        dt.datetime(2022, 9, 12, 10, 18, 52),
        None,
        None,
    ]
    assert cast(spark, "date", "2022-09-12 10:18:52", "x") == [dt.date(2022, 9, 12), None]
    assert cast(spark, "string", "a", None) == ["a", None]


def test_casts_are_one_projection(spark):
    raw = spark.createDataFrame([], schemas.as_text(schemas.COMMENTS))
    plan = clean.cast_columns(raw, schemas.COMMENTS)
    assert plan.schema.names == schemas.COMMENTS.names
    assert [f.dataType for f in plan.schema] == [f.dataType for f in schemas.COMMENTS]
    assert plan._jdf.queryExecution().analyzed().toString().count("Project [") == 1


def test_comment_layouts():
    assert len(schemas.COMMENTS) == 24
    raw = schemas.comments_raw()
    assert {f.dataType.simpleString() for f in raw if f.name != "score"} == {"string"}
    assert [f.name for f in raw if not f.nullable] == ["comment_id", "post_id"]
    assert schemas.comments_serving()["score"].dataType.simpleString() == "int"
    moving = schemas.with_text_times(schemas.COMMENTS)
    changed = [f.name for f in moving if f.dataType != schemas.COMMENTS[f.name].dataType]
    assert changed == ["created_time", "user_account_created_time", "post_created_time"]


def test_conform_by_name(spark):
    schema = schemas.layout(score="integer", id="string", note="string")
    df = spark.createDataFrame([("a", 3.7, 1), ("b", None, 2)], "id string, score double, extra int")
    conformed = clean.conform_to_schema(df, schema)
    assert conformed.schema.names == ["score", "id", "note"]
    assert tuples(conformed) == [(3, "a", None), (None, "b", None)]
    numbers = spark.createDataFrame([(2.0**40, True)], "score double, id boolean")
    assert tuples(clean.conform_to_schema(numbers, schema)) == [(None, "true", None)]


@pytest.fixture(scope="module")
def ragged(spark):
    return spark.createDataFrame(
        [(1, "a", None), (1, "a", "t"), (1, "a", "t"), (None, "b", "t"), (2, None, None)],
        "id int, name string, note string",
    )


def test_incomplete_and_repeated_rows(ragged):
    assert sorted(tuples(clean.drop_repeats(clean.drop_incomplete(ragged)))) == [(1, "a", "t")]
    some = clean.drop_repeats(clean.drop_incomplete(ragged, ["id", "name"]))
    assert sorted(tuples(some), key=repr) == [(1, "a", "t"), (1, "a", None)]


def test_rejects_and_accepted_rows_add_up(ragged):
    checked = clean.with_reject_reason(ragged, ["id", "name"])
    assert clean.accepted(checked).columns == ragged.columns
    assert clean.accepted(checked).count() == 3
    assert [row.reject_reason for row in clean.rejected(checked).collect()] == ["id", "name"]


def test_keep_latest(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "old"), ("a", 2, "p"), ("b", 1, None), (None, 1, "n"), (None, 3, "m")],
        "k string, load int, v string",
    )
    assert sorted(tuples(keep_latest(df, ["k"], ["load"])), key=repr) == [
        ("a", 2, "p"),
        ("b", 1, None),
        (None, 3, "m"),
    ]
    assert keep_latest(df.select("k"), ["k"]).count() == 3


def test_date_keys(spark):
    df = one_column(spark, "2024-01-05", "2024-1-5", "2024-01-05 10:11:12", "food", "", None)
    assert tuples(df.select(casts.parse_key_date(F.col("x")), casts.date_or_text(F.col("x")))) == [
        (dt.date(2024, 1, 5), "2024-01-05"),
        (dt.date(2024, 1, 5), "2024-01-05"),
        (dt.date(2024, 1, 5), "2024-01-05"),
        (None, "food"),
        (None, ""),
        (None, None),
    ]


TIMES = [
    "2024-01-05 10:11:12", "2024-02-29 00:00:00", "2023-02-29 00:00:00", "2024-13-01 00:00:00",
    "2024-01-32 00:00:00", "2024-01-05 24:00:00", "2024-01-05 23:60:00", "2024-01-05 23:59:60",
    "2024-1-5 10:11:12", "2024-01-05", "2024-01-05T10:11:12", "2024-01-05 10:11:12.5",
    "2024-01-05 10:11:12.000001", "2024-01-05 10:11:12.1234567", "2024-01-05 10:11:12.", "2024-01-05 10:11:12,5",
    "2024-01-05 10:11:12Z", " 2024-01-05 10:11:12", "2024-01-05 10:11:12 ", "24-01-05 10:11:12",
    "1969-12-31 23:59:59", "9999-12-31 23:59:59", "2024-01-05 10:11:12\n", "2024-01-05\n", "today", "", None,
]


def test_fast_time_parsing_agrees_with_the_pattern(spark):
    df = one_column(spark, *TIMES)
    fractions = [F.lit(casts.TIME_PATTERN + "." * (n > 0) + "S" * n) for n in range(7)]
    slow = F.coalesce(*[F.try_to_timestamp("x", pattern) for pattern in fractions])
    assert tuples(df.select(casts.parse_time(F.col("x")))) == tuples(df.select(slow))
    for key_pattern in ("yyyy-M-d", "yyyy-M-d H:m:s"):
        parsed = df.select("x", F.try_to_timestamp("x", F.lit(key_pattern)).cast("date").alias("slow"))
        wrong = parsed.where("slow IS NOT NULL").where(
            ~casts.parse_key_date(F.col("x")).eqNullSafe(F.col("slow"))
        )
        assert wrong.count() == 0
    either = F.coalesce(
        F.try_to_timestamp("x", F.lit("yyyy-M-d")), F.try_to_timestamp("x", F.lit("yyyy-M-d H:m:s"))
    ).cast("date")
    assert tuples(df.select(casts.parse_key_date(F.col("x")))) == tuples(df.select(either))


def test_missing_numbers_are_zero_and_bad_ones_fail_or_are_zero(spark):
    df = one_column(spark, "12", "", None)
    zero = casts.number_or_zero(F.col("x"), "int")
    assert [row[0] for row in df.select(zero).collect()] == [12, 0, 0]
    bad = one_column(spark, "12 items")
    with pytest.raises(PySparkException):
        bad.select(zero).collect()
    assert bad.select(casts.number_or_zero(F.col("x"), "int", strict=False)).first()[0] == 0


@pytest.mark.parametrize("strict", [True, False])
def test_a_number_that_does_not_fit_is_never_zero(spark, strict):
    large = one_column(spark, "3000000000")
    assert large.select(casts.number_or_zero(F.col("x"), "bigint", strict=strict)).first()[0] == 3_000_000_000
    with pytest.raises(PySparkException, match="3000000000"):
        large.select(casts.number_or_zero(F.col("x"), "int", strict=strict)).collect()


def test_serving_types_fail_rather_than_cut(spark):
    results = spark.createDataFrame([("a", "7", "12345678901.25", None)], LOOSE)
    typed = serving.normalize_results(results, key="k")
    assert tuples(serving.serving_types(typed).select("transactions_count", "total_amount")) == [
        (7, Decimal("12345678901.25"))
    ]
    larger = serving.normalize_results(results.withColumn("total_amount", F.lit("1234567890123.5")), key="k")
    assert tuples(larger.select("total_amount")) == [(Decimal("1234567890123.50"),)]
    with pytest.raises(PySparkException, match="1234567890123.50"):
        serving.serving_types(larger).collect()


def test_dates_and_times_keep_their_value(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-05 10:11:12.345678' AS n, TIMESTAMP'2024-01-05 10:11:12.345678' AS t, "
        "DATE'2024-01-05' AS d, '2024-01-05' AS day, '2024-01-05 23:59:59' AS moment, '5 Jan' AS none"
    )
    moment, day = dt.datetime(2024, 1, 5, 10, 11, 12, 345678), dt.date(2024, 1, 5)
    to_time = StructType([StructField(name, TimestampType()) for name in ("n", "t", "d")])
    assert tuples(clean.cast_columns(df, to_time).select("n", "t", "d")) == [
        (moment, moment, dt.datetime(2024, 1, 5))
    ]
    to_day = StructType([StructField(name, DateType()) for name in ("n", "t", "d", "day", "moment", "none")])
    assert tuples(clean.conform_to_schema(df, to_day)) == [(day, day, day, day, day, None)]
    to_ntz = StructType([StructField("t", TimestampNTZType())])
    assert tuples(clean.conform_to_schema(df, to_ntz)) == [(moment,)]


LOOSE = "k string, transactions_count string, total_amount string, avg_amount string"


@pytest.fixture(scope="module")
def loose(spark):
    return spark.createDataFrame(
        [
            ("2024-01-05", "2", "10.555", "5.2775"),
            ("2024-1-6", None, "", None),
            ("2024-01-07 10:11:12", "1", "1", "1"),
            ("2024 food", "3", "9", "3"),
            ("", "1", "1", "1"),
            (None, "1", "1", "1"),
        ],
        LOOSE,
    )


def test_normalized_dates(loose):
    typed = serving.normalize_results(loose, key="k", key_type="date")
    assert typed.dtypes == [
        ("k", "date"),
        ("transactions_count", "bigint"),
        ("total_amount", "decimal(38,2)"),
        ("avg_amount", "decimal(38,2)"),
    ]
    assert tuples(typed) == [
        (dt.date(2024, 1, 5), 2, Decimal("10.56"), Decimal("5.28")),
        (dt.date(2024, 1, 6), 0, Decimal("0.00"), Decimal("0.00")),
        (dt.date(2024, 1, 7), 1, Decimal("1.00"), Decimal("1.00")),
    ]
    assert [row.k for row in serving.unparsed_results(loose, key="k").collect()] == ["2024 food"]


def test_normalized_text_keeps_a_category_spelled_like_a_date(loose):
    assert [row.k for row in serving.normalize_results(loose, key="k").collect()] == [
        "2024-01-05",
        "2024-1-6",
        "2024-01-07 10:11:12",
        "2024 food",
    ]
    mixed = serving.normalize_results(loose, key="k", key_type="mixed")
    assert [row.k for row in mixed.collect()] == ["2024-01-05", "2024-01-06", "2024-01-07", "2024 food"]
    with pytest.raises(ValueError):
        serving.normalize_results(loose, key="k", key_type="number")
    expected = schemas.serving_result("k", loose.schema["k"].dataType)
    typed = serving.serving_types(serving.normalize_results(loose, key="k")).schema
    assert [(f.name, f.dataType) for f in typed] == [(f.name, f.dataType) for f in expected]


def test_day_label_and_start(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 12, 30, 5),), (dt.datetime(2023, 1, 1),), (dt.datetime(2020, 2, 29, 23, 59),)],
        "t timestamp",
    )
    assert tuples(df.select(labels.iso_day_label(F.col("t")), labels.start_of_day(F.col("t")))) == [
        ("Mon 30 Dec 2025", dt.datetime(2024, 12, 30)),
        ("Sun 01 Jan 2022", dt.datetime(2023, 1, 1)),
        ("Sat 29 Feb 2020", dt.datetime(2020, 2, 29)),
    ]


def test_duration_text(spark):
    df = spark.createDataFrame([(7800,), (359,), (90061,), (400000,), (None,)], "s int")
    assert [row[0] for row in df.select(labels.duration_text(F.col("s"))).collect()] == [
        "02:10:00",
        "00:05:59",
        "25:01:01",
        "111:06:40",
        None,
    ]


def test_interval_text(spark):
    df = spark.sql("SELECT * FROM VALUES (INTERVAL '0 02:10:00' DAY TO SECOND), (INTERVAL '1 01:01:01' DAY TO SECOND), (-INTERVAL '0 00:05:59' DAY TO SECOND), (NULL) t(i)")
    assert [row[0] for row in df.select(labels.interval_text(F.col("i"))).collect()] == [
        "02:10:00",
        "25:01:01",
        "-00:05:59",
        None,
    ]


def test_records_leave_nulls_out_or_keep_them(spark):
    df = spark.createDataFrame([("first", None)], "msg string, note string")
    assert records.encode_rows(df).first().value == '{"msg":"first"}'
    assert records.encode_rows(df, keep_nulls=True).first().value == '{"msg":"first","note":null}'


def test_decoding_bad_records(spark):
    schema = schemas.layout(id="integer", at="timestamp", name="string")
    df = spark.createDataFrame(
        [
            (bytearray(b'{"id":1,"at":"2024-01-01 10:00:00","name":"a","more":2}'),),
            (bytearray(b'{"id":"x","name":"b"}'),),
            (bytearray(b"no json"),),
            (None,),
        ],
        "value binary",
    )
    assert tuples(decode_records(df, schema)) == [
        (1, dt.datetime(2024, 1, 1, 10), "a"),
        (None, None, "b"),
        (None, None, None),
        (None, None, None),
    ]


def comment(spark, **changes):
    base = {field.name: "1" for field in schemas.COMMENTS}
    for field in schemas.COMMENTS:
        if field.dataType.typeName() == "timestamp":
            base[field.name] = "2022-09-12 10:18:52"
        if field.dataType.typeName() == "boolean":
            base[field.name] = "True"
    return {**base, **changes}


def comment_rows(spark):
    rows = [
        comment(spark, comment_id="a", self_text='two\nlines, "quoted"'),
        comment(spark, comment_id="a", self_text='two\nlines, "quoted"'),
        comment(spark, comment_id="b", created_time="2022-09-12T10:18:52Z"),
        comment(spark, comment_id="c", user_link_karma="many"),
        comment(spark, comment_id="d", post_self_text=None),
        comment(spark, comment_id="e", ups="12.0"),
    ]
    schema = schemas.as_text(schemas.COMMENTS)
    return spark.createDataFrame([tuple(row[n] for n in schema.names) for row in rows], schema)


def test_feed_is_cleaned_into_parquet(spark, folder):
    comment_rows(spark).write.options(header="true", escape='"').csv(folder + "-in")
    cleaned = comments.csv_to_parquet_clean(spark, folder + "-in", folder)
    assert [(f.name, f.dataType) for f in cleaned.schema] == [(f.name, f.dataType) for f in schemas.COMMENTS]
    kept = {row.comment_id: row for row in cleaned.collect()}
    assert sorted(kept) == ["a", "e"] and cleaned.count() == 2
    assert kept["a"].self_text == 'two\nlines, "quoted"' and kept["e"].ups == 12
    required = [name for name in schemas.COMMENTS.names if name != "post_self_text"]
    again = comments.csv_to_parquet_clean(spark, folder + "-in", folder, required=required)
    assert sorted(row.comment_id for row in again.collect()) == ["a", "d", "e"]


def test_feed_missing_file_fails(spark, folder):
    with pytest.raises(PySparkException):
        comments.csv_to_parquet_clean(spark, folder + "-none", folder)


def test_stream_message_round_trip(spark):
    typed = comments.clean_rows(comment_rows(spark))
    sent = records.encode_rows(records.times_as_text(typed))
    assert sorted(tuples(decode_records(sent, schemas.COMMENTS))) == sorted(tuples(typed))
    serving_rows = clean.conform_to_schema(typed, schemas.comments_serving())
    assert serving_rows.schema["score"].dataType.simpleString() == "int"
    assert isinstance(serving_rows.schema, StructType)


def test_migrated_totals_may_pass_those_of_a_row(spark, folder):
    logs = spark.createDataFrame([(n, "a") for n in range(3)], "transaction_id long, category string")
    rows = [(n, dt.datetime(2024, 1, 5), Decimal(f"60000000000{n}.25")) for n in range(3)]
    deals = spark.createDataFrame(rows, "transaction_id long, transaction_date timestamp, amount decimal(14,2)")
    serving.migrate_categories(logs, deals, folder + "-c", 1)
    serving.migrate_days(deals, folder + "-d", 1)
    for root in (folder + "-c", folder + "-d"):
        found = spark.read.parquet(root).select("transactions_count", "total_amount", "avg_amount")
        assert tuples(found) == [(3, Decimal("1800000000003.75"), Decimal("600000000001.25"))]
