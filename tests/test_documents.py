"""Documents: missing classes, open flights, unboarded tickets, oversized groups."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemill import scratch
from tidemill.catalog import documents as on_tables
from tidemill.catalog.tables import LAYOUTS
from tidemill.operators import parts
from tidemill.operators.parts import in_parts
from tidemill.plans import documents
from tidemill.sinks.files import write_documents
from tidemill.sources.files import read_json_doc


@pytest.fixture(scope="module")
def aircraft(spark):
    return spark.createDataFrame(
        [("A1", "alpha", 100), ("B2", "beta", 200), ("C3", "gamma", 300)],
        "aircraft_code string, model string, range int",
    )


@pytest.fixture(scope="module")
def seats(spark):
    return spark.createDataFrame(
        [
            ("A1", "2A", "Economy"),
            ("A1", "1B", "Economy"),
            ("A1", "1A", "Business"),
            ("B2", "1A", "Comfort"),
            ("Z9", "1A", "Economy"),
        ],
        "aircraft_code string, seat_no string, fare_conditions string",
    )


def test_aircraft_seats_by_class(aircraft, seats):
    result = sorted(tuple(row) for row in documents.aircraft_seat_document(aircraft, seats).collect())
    assert result == [
        ("A1", "alpha", 100, 0, 1, ["1B", "2A"], ["1A"], None),
        ("B2", "beta", 200, 0, 1, None, None, ["1A"]),
    ]


def test_oversized_aircraft_keeps_every_seat(spark, aircraft):
    many = spark.range(500).select(
        F.lit("A1").alias("aircraft_code"),
        F.col("id").cast("string").alias("seat_no"),
        F.when(F.col("id") % 2 == 0, "Economy").otherwise("Business").alias("fare_conditions"),
    )
    few = many.limit(3).withColumn("aircraft_code", F.lit("B2"))
    result = documents.aircraft_seat_document(aircraft, many.union(few), part_size=50).collect()
    big = sorted((row for row in result if row.aircraft_code == "A1"), key=lambda row: row.part)
    numbers = sorted(map(str, range(500)))
    assert [row.part for row in big] == list(range(10)) and {row.parts for row in big} == {10}
    for name, rest in (("economy_seats", 0), ("business_seats", 1)):
        found = [seat for row in big for seat in getattr(row, name) or []]
        assert found == [n for n in numbers if int(n) % 2 == rest], "the parts in order are the array"
    assert {sum(len(getattr(row, f"{c}_seats") or []) for c in ("economy", "business")) for row in big} == {50}
    assert [(row.part, row.parts) for row in result if row.aircraft_code == "B2"] == [(0, 1)]


TIMES = [f"{name} timestamp" for name in documents.FLIGHT_TIMES if not name.endswith("duration")]
FLIGHT = (
    "flight_id int, flight_no string, status string, aircraft_code string, "
    "departure_airport string, departure_airport_name string, departure_city string, "
    "arrival_airport string, arrival_airport_name string, arrival_city string, "
    "scheduled_duration string, actual_duration string, " + ", ".join(TIMES)
)


@pytest.fixture(scope="module")
def flights(spark):
    none = [None] * len(TIMES)
    return spark.createDataFrame(
        [
            (1, "F1", "Arrived", "A1", "X", "Ex", "Xcity", "Y", "Why", "Ycity", "01:00:00", None, *none),
            (2, "F2", "Scheduled", "A1", "X", "Ex", "Xcity", "X", "Ex", "Xcity", "01:00:00", None, *none),
            (3, "F3", "Arrived", "C3", "X", "Ex", "Xcity", "Y", "Why", "Ycity", "01:00:00", None, *none),
            (4, "F4", "Arrived", "B2", "X", "Ex", "Xcity", "Q", "Que", "Qcity", "01:00:00", None, *none),
        ],
        FLIGHT,
    )


@pytest.fixture(scope="module")
def airports(spark):
    return spark.createDataFrame(
        [("X", "(1,2)", "UTC"), ("Y", "(3,4)", "CET")],
        "airport_code string, coordinates string, timezone string",
    )


def test_flight_objects(aircraft, seats, flights, airports):
    built = documents.flight_document(
        flights, documents.written_documents(documents.aircraft_seat_document(aircraft, seats)), airports
    )
    result = {row.flight_id: row for row in built.collect()}
    assert set(result) == {1, 2}, "no seats for C3, no airport Q"
    assert result[1].aircraft.economy_seats == ["1B", "2A"] and (result[1].part, result[1].parts) == (0, 1)
    assert result[1].departure_airport.asDict() == {
        "airport_code": "X",
        "airport_name": "Ex",
        "city": "Xcity",
        "coordinates": "(1,2)",
        "timezone": "UTC",
    }
    assert result[1].arrival_airport.timezone == "CET"
    assert result[2].departure_airport == result[2].arrival_airport
    assert result[2].flight_time.actual_departure is None and "actual_duration" in result[2].flight_time


def test_flights_hold_every_part_of_their_aircraft(spark, aircraft, flights, airports):
    many = spark.range(300).select(
        F.lit("A1").alias("aircraft_code"),
        F.col("id").cast("string").alias("seat_no"),
        F.lit("Economy").alias("fare_conditions"),
    )
    crafts = documents.aircraft_seat_document(aircraft, many, part_size=30)
    result = documents.flight_document(flights, crafts, airports).collect()
    for flight in (1, 2):
        parts = sorted((row for row in result if row.flight_id == flight), key=lambda row: row.part)
        assert [(row.part, row.parts) for row in parts] == [(n, 10) for n in range(10)]
        assert [seat for row in parts for seat in row.aircraft.economy_seats] == sorted(map(str, range(300)))


@pytest.fixture(scope="module")
def booked(spark):
    bookings = spark.createDataFrame(
        [("b1", 10.0), ("b2", 20.0), ("b3", 30.0)], "book_ref string, total_amount double"
    ).withColumn("book_date", F.lit("2024-01-01"))
    tickets = spark.createDataFrame(
        [("t1", "b1", "p1", "Ann", '{"phone":"1"}'), ("t2", "b1", "p2", "Bob", None), ("t3", "b2", "p3", "Cy", None)],
        "ticket_no string, book_ref string, passenger_id string, passenger_name string, contact_data string",
    )
    legs = spark.createDataFrame(
        [("t1", 1, "Economy", 5.0), ("t1", 2, "Economy", 6.0), ("t2", 1, "Business", 9.0), ("t3", 1, "Economy", 5.0)],
        "ticket_no string, flight_id int, fare_conditions string, amount double",
    )
    passes = spark.createDataFrame(
        [("t1", 1, "1A"), ("t1", 9, "9Z")], "ticket_no string, flight_id int, seat_no string"
    )
    return bookings, tickets, legs, passes


def test_booking_tickets_kept_without_boarding_pass(booked):
    result = {row.book_ref: row for row in documents.booking_document(*booked).collect()}
    assert set(result) == {"b1", "b2"}
    found = [(t.ticket_no, t.flight_id, t.passenger_name, t.seat_no) for t in result["b1"].tickets]
    assert found == [("t1", 1, "Ann", "1A"), ("t1", 2, "Ann", None), ("t2", 1, "Bob", None)]
    assert (result["b1"].part, result["b1"].parts) == (0, 1)


def test_oversized_booking_keeps_every_element(spark):
    bookings = spark.createDataFrame([("b1", 1.0), ("b2", 2.0)], "book_ref string, total_amount double").withColumn(
        "book_date", F.lit("x")
    )
    tickets = spark.range(400).select(
        F.col("id").alias("ticket_no"),
        F.when(F.col("id") < 390, "b1").otherwise("b2").alias("book_ref"),
        *[F.lit("x").alias(c) for c in ("passenger_id", "passenger_name", "contact_data")],
    )
    legs = spark.range(400).select(
        F.col("id").alias("ticket_no"), F.lit(1).alias("flight_id"),
        F.lit("Economy").alias("fare_conditions"), F.lit(1.0).alias("amount"),
    )
    passes = legs.where("ticket_no < 5").select("ticket_no", "flight_id", F.lit("1A").alias("seat_no"))
    result = documents.booking_document(bookings, tickets, legs, passes, part_size=40).collect()
    found = [t.ticket_no for row in result if row.book_ref == "b1" for t in row.tickets]
    assert sorted(found) == list(range(390))
    big = sorted((row for row in result if row.book_ref == "b1"), key=lambda row: row.part)
    assert [t.ticket_no for row in big for t in row.tickets] == list(range(390))
    assert [len(row.tickets) for row in big] == [40] * 9 + [30]
    assert [(row.part, row.parts, len(row.tickets)) for row in result if row.book_ref == "b2"] == [(0, 1, 10)]


def test_parts_of_rows_over_many_slices(spark):
    rows = spark.range(2000).selectExpr("CASE WHEN id < 1500 THEN 'large' ELSE concat('k', id % 50) END AS k", "(id * 7919) % 2000 AS at")
    placed, several = in_parts(rows, ["k"], ["at"], part_size=11)
    assert {row.k: row.parts for row in several.collect()} == {"large": 137}
    found = {}
    for row in placed.collect():
        found.setdefault((row.k, row.part), []).append(row.at)
    large = sorted(at for (k, _), values in found.items() for at in values if k == "large")
    assert len(large) == 1500
    assert all(sorted(found["large", n]) == large[11 * n : 11 * n + 11] for n in range(137))
    assert all(part == 0 and len(values) == 10 for (k, part), values in found.items() if k != "large")


def test_bookings_take_few_shuffles(spark, booked, monkeypatch):
    plans = []

    def shuffles(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")

    def recorded(df, name):
        plans.append(shuffles(df))
        return scratch.write_table(df, name)

    monkeypatch.setattr(documents, "write_table", recorded)
    monkeypatch.setattr(parts, "write_table", recorded)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = documents.booking_document(*booked)
        assert shuffles(built) + sum(plans) <= 9 and len(plans) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_have_parts_too(spark):
    rows = spark.range(100).select(F.lit(None).cast("string").alias("k"), "id")
    placed, parts = in_parts(rows, ["k"], ["id"], part_size=10)
    assert all(row.part == row.id // 10 for row in placed.collect()) and placed.count() == 100
    assert [tuple(row) for row in parts.collect()] == [(None, 10)]


def test_collection_keeps_null_fields(aircraft, seats, folder, spark):
    built = documents.aircraft_seat_document(aircraft, seats)
    write_documents(built, folder)
    texts = [json.loads(row.value) for row in spark.read.text(folder).collect()]
    assert all("comfort_seats" in text for text in texts)
    again = read_json_doc(spark, folder, schema=built.schema, one_per_line=True)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, built.collect()))
    write_documents(built, folder + "-nested", file_format="parquet")
    assert spark.read.parquet(folder + "-nested").count() == 2


def test_json_collections_are_compressed_in_bounded_files(spark, folder, monkeypatch):
    monkeypatch.setattr("tidemill.sinks.files.FILE_DOCUMENTS", 40)
    rows = spark.range(100).select("id", F.lit("x" * 500).alias("text")).coalesce(1)
    write_documents(rows, folder)
    files = [name for name in os.listdir(folder) if name.startswith("part-")]
    assert len(files) == 3 and all(name.endswith(".json.gz") for name in files)
    assert sum(os.path.getsize(f"{folder}/{name}") for name in files) < 10_000
    assert read_json_doc(spark, folder, schema=rows.schema, one_per_line=True).exceptAll(rows).isEmpty()
    write_documents(rows, folder + "-plain", options={"compression": "none"})
    assert all(not name.endswith(".gz") for name in os.listdir(folder + "-plain"))


def test_derived_columns_of_flights_follow_the_joins(aircraft, seats, flights, airports):
    crafts = documents.written_documents(documents.aircraft_seat_document(aircraft, seats))
    plain = flights.drop("scheduled_duration", "actual_duration")
    given = {"scheduled_duration": F.lit("24:00:00"), "actual_duration": F.concat("flight_no", F.lit("-marked"))}
    built = documents.flight_document(plain, crafts, airports, derived=given)
    whole = documents.flight_document(flights.withColumns(given), crafts, airports)
    assert built.exceptAll(whole).isEmpty() and whole.exceptAll(built).isEmpty() and not built.isEmpty()
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    assert "-marked" in plan.split("Join", 1)[0] and "-marked" not in plan.split("Join", 1)[1]


def test_flights_of_the_tables_derive_times_after_the_joins(spark, folder):
    for name in ("customer", "lineitem", "nation", "orders", "part", "region", "supplier"):
        spark.createDataFrame([], LAYOUTS[name]).write.parquet(f"{folder}/{name}.parquet")
    built = on_tables.flight_document(spark, folder)
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    assert "make_dt_interval" in plan.split("Join", 1)[0] and "make_dt_interval" not in plan.split("Join", 1)[1]
