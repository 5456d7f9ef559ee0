"""Nested documents on the test tables; objects and arrays are returned as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tidemill.catalog.tables import money, table
from tidemill.functions.casts import TIME_PATTERN
from tidemill.functions.labels import interval_text
from tidemill.plans import documents
from tidemill.scratch import new_path, write_table
from tidemill.sinks.files import write_documents
from tidemill.sources.files import read_json_doc

FLAG_CLASSES = {"economy_seats": "A", "business_seats": "N", "comfort_seats": "R"}
JSON_TEXT = {"ignoreNullFields": "false", "timestampNTZFormat": TIME_PATTERN}


def _seats(spark: SparkSession, folder: str, code: str) -> DataFrame:
    """Line numbers as seats: each once per parent and class, however often it repeats.

    Written, as a seat table would be, since documents read it twice.
    """
    seats = table(spark, folder, "lineitem").select(
        F.col(code).alias("aircraft_code"),
        F.col("l_linenumber").cast("string").alias("seat_no"),
        F.col("l_returnflag").alias("fare_conditions"),
    )
    return write_table(seats.distinct(), "seats")


def aircraft_seat_document(spark: SparkSession, folder: str) -> DataFrame:
    aircraft = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("aircraft_code"),
        F.col("o_orderpriority").alias("model"),
        F.col("o_custkey").alias("range"),
    )
    built = documents.aircraft_seat_document(
        aircraft, _seats(spark, folder, "l_orderkey"), classes=FLAG_CLASSES
    )
    return built.withColumns({name: F.array_join(name, ",") for name in FLAG_CLASSES})


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("aircraft_code"),
        F.col("p_name").alias("model"),
        F.col("p_size").alias("range"),
    )


def _airports(spark: SparkSession, folder: str) -> DataFrame:
    nations, regions = table(spark, folder, "nation"), table(spark, folder, "region")
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        F.col("n_nationkey").alias("airport_code"),
        F.col("n_name").alias("coordinates"),
        F.col("r_name").alias("timezone"),
    )


def _flights(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as flights from the supplier's to the customer's nation; open lines have not left."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_nationkey").alias("arrival_airport"),
        F.col("c_name").alias("arrival_airport_name"),
        F.col("c_mktsegment").alias("arrival_city"),
    )
    orders = (
        table(spark, folder, "orders")
        .select(
            F.col("o_orderkey").alias("l_orderkey"),
            "o_custkey",
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderdate").alias("scheduled_departure"),
        )
        .join(customers, "o_custkey")
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.col("s_nationkey").alias("departure_airport"),
        F.col("s_name").alias("departure_airport_name"),
    )
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_suppkey",
        F.col("l_partkey").alias("aircraft_code"),
        F.col("l_linenumber").cast("string").alias("flight_no"),
        F.col("l_returnflag").alias("departure_city"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("actual_departure"),
        F.col("l_quantity").cast("int").alias("hours"),
    )
    return (
        lines.join(orders, "l_orderkey")
        .join(suppliers, "l_suppkey")
        .select(
            F.col("l_orderkey").alias("flight_id"),
            "flight_no",
            "status",
            "aircraft_code",
            "departure_airport",
            "departure_airport_name",
            "departure_city",
            "arrival_airport",
            "arrival_airport_name",
            "arrival_city",
            "scheduled_departure",
            "actual_departure",
            "hours",
        )
    )


def _flight_times() -> dict[str, Column]:
    """The times of a flight that follow from its departures and hours; a scheduled flight takes a day."""
    leaves, left = F.col("scheduled_departure"), F.col("actual_departure")
    arrives, arrived = leaves + F.expr("INTERVAL '1' DAY"), left + F.expr("make_dt_interval(0, hours)")
    return {
        "scheduled_departure_local": leaves,
        "scheduled_arrival": arrives,
        "scheduled_arrival_local": arrives,
        "scheduled_duration": interval_text(arrives - leaves),
        "actual_departure_local": left,
        "actual_arrival": arrived,
        "actual_arrival_local": arrived,
        "actual_duration": interval_text(arrived - left),
    }


def flight_document(spark: SparkSession, folder: str) -> DataFrame:
    aircraft = documents.aircraft_seat_document(
        _parts(spark, folder), _seats(spark, folder, "l_partkey"), classes=FLAG_CLASSES
    )
    built = documents.flight_document(
        _flights(spark, folder),
        documents.written_documents(aircraft),
        _airports(spark, folder),
        classes=FLAG_CLASSES,
        derived=_flight_times(),
    )
    objects = ("aircraft", "departure_airport", "arrival_airport", "flight_time")
    return built.withColumns({name: F.to_json(name, JSON_TEXT) for name in objects})


def _booking_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Customers as bookings of their orders; returned lines are the boarded ones."""
    lines = table(spark, folder, "lineitem")
    key = (F.col("l_orderkey").alias("ticket_no"), F.col("l_linenumber").alias("flight_id"))
    return {
        "bookings": table(spark, folder, "customer").select(
            F.col("c_custkey").alias("book_ref"),
            F.col("c_mktsegment").alias("book_date"),
            F.col("c_acctbal").alias("total_amount"),
        ),
        "tickets": table(spark, folder, "orders").select(
            F.col("o_orderkey").alias("ticket_no"),
            F.col("o_custkey").alias("book_ref"),
            F.col("o_custkey").alias("passenger_id"),
            F.col("o_orderpriority").alias("passenger_name"),
            F.col("o_orderstatus").alias("contact_data"),
        ),
        "ticket_flights": lines.groupBy(*key).agg(
            F.max("l_returnflag").alias("fare_conditions"),
            F.max(money("l_extendedprice")).cast("string").alias("amount"),
        ),
        "boarding_passes": lines.where(F.col("l_returnflag") == "R")
        .groupBy(*key)
        .agg(F.max("l_suppkey").alias("seat_no")),
    }


def booking_document(spark: SparkSession, folder: str) -> DataFrame:
    built = documents.booking_document(**_booking_tables(spark, folder))
    return built.withColumn("tickets", F.to_json("tickets", JSON_TEXT))


SMALL_PART = 3


def booking_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Booking documents of so few tickets that most bookings have several."""
    built = documents.booking_document(**_booking_tables(spark, folder), part_size=SMALL_PART)
    return built.withColumn("tickets", F.to_json("tickets", JSON_TEXT))


def document_collection(spark: SparkSession, folder: str) -> DataFrame:
    """The bookings written as a collection, read back and unrolled to one row per element."""
    built = documents.booking_document(**_booking_tables(spark, folder))
    path = new_path(spark, "bookings")
    write_documents(built, path)
    elements = read_json_doc(spark, path, schema=built.schema, one_per_line=True).select(
        "book_ref", F.explode("tickets").alias("ticket")
    )
    return elements.select("book_ref", "ticket.*")


def document_collections(spark: SparkSession, folder: str) -> DataFrame:
    """All three collections written as JSON, and every document read back whole as text."""
    root = new_path(spark, "collections")
    schemas = {}

    def write(built: DataFrame, name: str) -> None:
        schemas[name] = built.schema
        write_documents(built, f"{root}/{name}")

    documents.write_collections(
        {
            "aircraft": _parts(spark, folder),
            "seats": _seats(spark, folder, "l_partkey"),
            "flights": _flights(spark, folder),
            "airports": _airports(spark, folder),
            **_booking_tables(spark, folder),
        },
        write,
        classes=FLAG_CLASSES,
        derived=_flight_times(),
    )
    keys = {"aircrafts": "aircraft_code", "flights": "flight_id", "bookings": "book_ref"}
    found = []
    for name, key in keys.items():
        read = read_json_doc(spark, f"{root}/{name}", schema=schemas[name], one_per_line=True)
        found.append(
            read.select(
                F.lit(name).alias("collection"),
                F.col(key).alias("document_key"),
                "part",
                "parts",
                (F.col("total_amount") if name == "bookings" else F.lit(None).cast("double")).alias("total_amount"),
                F.concat_ws("|", *[_text(read, field) for field in BODIES[name]]).alias("body"),
            )
        )
    return found[0].union(found[1]).union(found[2])


# The fields of a document beside its key, as the comparison puts them together.
BODIES = {
    "aircrafts": ("model", "range", *FLAG_CLASSES),
    "flights": ("flight_no", "aircraft", "departure_airport", "arrival_airport", "flight_time", "status"),
    "bookings": ("book_date", "tickets"),
}


def _text(read: DataFrame, field: str) -> Column:
    """A field as text; what is missing is marked."""
    kind = read.schema[field].dataType
    if field in FLAG_CLASSES:
        text = F.array_join(field, ",")
    elif isinstance(kind, (StructType, ArrayType)):
        text = F.to_json(field, JSON_TEXT)
    else:
        text = F.col(field).cast("string")
    return F.coalesce(text, F.lit("-"))


def json_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Texts as nested documents of their lines, read back and unrolled to one row per line."""
    nested = table(spark, folder, "documents").select(
        "doc_id", "lang", F.split("text", "\n").alias("lines")
    )
    path = new_path(spark, "texts")
    write_documents(nested, path)
    return read_json_doc(spark, path, schema=nested.schema, one_per_line=True).select(
        "doc_id", "lang", F.posexplode_outer("lines").alias("line_no", "line")
    )


QUERIES = {
    "aircraft_seat_document": aircraft_seat_document,
    "flight_document": flight_document,
    "booking_document": booking_document,
    "booking_parts": booking_parts,
    "document_collection": document_collection,
    "document_collections": document_collections,
    "json_documents": json_documents,
}

_TICKETS = """
    SELECT o.o_custkey AS book_ref, t.ticket_no, t.flight_id, o.o_custkey AS passenger_id,
           o.o_orderpriority AS passenger_name, o.o_orderstatus AS contact_data,
           t.fare_conditions, t.amount, b.seat_no
    FROM (
        SELECT l_orderkey AS ticket_no, l_linenumber AS flight_id,
               MAX(l_returnflag) AS fare_conditions,
               CAST(MAX(CAST(l_extendedprice AS DECIMAL(12,2))) AS VARCHAR) AS amount
        FROM lineitem GROUP BY l_orderkey, l_linenumber
    ) t
    JOIN orders o ON o.o_orderkey = t.ticket_no
    LEFT JOIN (
        SELECT l_orderkey AS ticket_no, l_linenumber AS flight_id, MAX(l_suppkey) AS seat_no
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_linenumber
    ) b ON b.ticket_no = t.ticket_no AND b.flight_id = t.flight_id
"""


def _aircraft(table_name: str, key: str, model: str, size: str, seat_key: str) -> str:
    """Aircraft documents of one part each, the seat arrays joined by commas."""
    arrays = ", ".join(
        f"STRING_AGG(seat, ',' ORDER BY seat) FILTER (WHERE flag = '{flag}') AS {name}"
        for name, flag in FLAG_CLASSES.items()
    )
    return f"""
        SELECT {key} AS aircraft_code, {model} AS model, {size} AS range, 0 AS part, 1 AS parts, {arrays}
        FROM {table_name} JOIN (
            SELECT DISTINCT {seat_key} AS seat_key, CAST(l_linenumber AS VARCHAR) AS seat, l_returnflag AS flag
            FROM lineitem
        ) ON seat_key = {key}
        GROUP BY {key}, {model}, {size}
    """


def _bookings(part_size: int) -> str:
    """Booking documents of ``part_size`` tickets in order."""
    return f"""
        SELECT book_ref, part, parts, book_date, total_amount,
               CAST(to_json(LIST(json_object('ticket_no', ticket_no, 'flight_id', flight_id,
                    'passenger_id', passenger_id, 'passenger_name', passenger_name,
                    'contact_data', contact_data, 'fare_conditions', fare_conditions,
                    'amount', amount, 'seat_no', seat_no) ORDER BY ticket_no, flight_id))
                    AS VARCHAR) AS tickets
        FROM (
            SELECT t.*, c_mktsegment AS book_date, c_acctbal AS total_amount,
                   CAST((row_number() OVER (PARTITION BY book_ref ORDER BY ticket_no, flight_id) - 1)
                        // {part_size} AS INTEGER) AS part,
                   CAST((COUNT(*) OVER (PARTITION BY book_ref) - 1) // {part_size} + 1 AS INTEGER) AS parts
            FROM customer JOIN ({_TICKETS}) t ON c_custkey = book_ref
        )
        GROUP BY book_ref, part, parts, book_date, total_amount
    """


def _body(name: str) -> str:
    return "concat_ws('|', " + ", ".join(f"COALESCE(CAST({field} AS VARCHAR), '-')" for field in BODIES[name]) + ")"


_FLIGHTS = """
        WITH seats AS (
            SELECT DISTINCT l_partkey, CAST(l_linenumber AS VARCHAR) AS seat, l_returnflag AS flag
            FROM lineitem
        ), aircraft AS (
            SELECT p_partkey, p_name, p_size,
                   LIST(seat ORDER BY seat) FILTER (WHERE flag = 'A') AS economy_seats,
                   LIST(seat ORDER BY seat) FILTER (WHERE flag = 'N') AS business_seats,
                   LIST(seat ORDER BY seat) FILTER (WHERE flag = 'R') AS comfort_seats
            FROM part JOIN seats ON l_partkey = p_partkey
            GROUP BY p_partkey, p_name, p_size
        ), airports AS (
            SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
        ), flights AS (
            SELECT *, o_orderdate AS planned, o_orderdate + INTERVAL 1 DAY AS planned_arrival,
                   CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS left_at,
                   CAST(l_quantity AS INTEGER) AS hours
            FROM lineitem
            JOIN orders ON l_orderkey = o_orderkey
            JOIN customer ON o_custkey = c_custkey
            JOIN supplier ON l_suppkey = s_suppkey
        )
        SELECT f.l_orderkey AS flight_id, 0 AS part, 1 AS parts, CAST(f.l_linenumber AS VARCHAR) AS flight_no,
               CAST(json_object('aircraft_code', a.p_partkey, 'model', a.p_name, 'range', a.p_size,
                    'economy_seats', a.economy_seats, 'business_seats', a.business_seats,
                    'comfort_seats', a.comfort_seats) AS VARCHAR) AS aircraft,
               CAST(json_object('airport_code', s_nationkey, 'airport_name', s_name,
                    'city', l_returnflag, 'coordinates', d.n_name, 'timezone', d.r_name)
                    AS VARCHAR) AS departure_airport,
               CAST(json_object('airport_code', c_nationkey, 'airport_name', c_name,
                    'city', c_mktsegment, 'coordinates', r.n_name, 'timezone', r.r_name)
                    AS VARCHAR) AS arrival_airport,
               CAST(json_object(
                    'scheduled_departure', strftime(planned, '%Y-%m-%d %H:%M:%S'),
                    'scheduled_departure_local', strftime(planned, '%Y-%m-%d %H:%M:%S'),
                    'scheduled_arrival', strftime(planned_arrival, '%Y-%m-%d %H:%M:%S'),
                    'scheduled_arrival_local', strftime(planned_arrival, '%Y-%m-%d %H:%M:%S'),
                    'scheduled_duration', '24:00:00',
                    'actual_departure', strftime(left_at, '%Y-%m-%d %H:%M:%S'),
                    'actual_departure_local', strftime(left_at, '%Y-%m-%d %H:%M:%S'),
                    'actual_arrival', strftime(left_at + to_hours(hours), '%Y-%m-%d %H:%M:%S'),
                    'actual_arrival_local', strftime(left_at + to_hours(hours), '%Y-%m-%d %H:%M:%S'),
                    'actual_duration', CASE WHEN left_at IS NOT NULL
                        THEN lpad(CAST(hours AS VARCHAR), 2, '0') || ':00:00' END)
                    AS VARCHAR) AS flight_time,
               o_orderstatus AS status
        FROM flights f
        JOIN aircraft a ON f.l_partkey = a.p_partkey
        JOIN airports d ON s_nationkey = d.n_nationkey
        JOIN airports r ON c_nationkey = r.n_nationkey
"""

SQL = {
    "aircraft_seat_document": _aircraft("orders", "o_orderkey", "o_orderpriority", "o_custkey", "l_orderkey"),
    "flight_document": _FLIGHTS,
    "booking_document": _bookings(10_000),
    "booking_parts": _bookings(SMALL_PART),
    "document_collection": f"""
        SELECT t.* FROM customer JOIN ({_TICKETS}) t ON c_custkey = book_ref
    """,
    "document_collections": f"""
        SELECT 'aircrafts' AS collection, aircraft_code AS document_key, part, parts,
               CAST(NULL AS DOUBLE) AS total_amount, {_body("aircrafts")} AS body
        FROM ({_aircraft("part", "p_partkey", "p_name", "p_size", "l_partkey")})
        UNION ALL
        SELECT 'flights', flight_id, part, parts, NULL, {_body("flights")} FROM ({_FLIGHTS})
        UNION ALL
        SELECT 'bookings', book_ref, part, parts, total_amount, {_body("bookings")} FROM ({_bookings(10_000)})
    """,
    "json_documents": """
        SELECT doc_id, lang, CAST(place - 1 AS INTEGER) AS line_no, line
        FROM (
            SELECT doc_id, lang, UNNEST(lines) AS line, generate_subscripts(lines, 1) AS place
            FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS lines FROM documents)
        )
    """,
}
