"""Nested documents built from normalized flight tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.parts import PART_SIZE, in_parts, owners_of_parts
from tidemill.scratch import write_table

# The array of each fare class in an aircraft document.
SEAT_CLASSES = {
    "economy_seats": "Economy",
    "business_seats": "Business",
    "comfort_seats": "Comfort",
}
# The fields of a flight's time object and of a booking's ticket object.
FLIGHT_TIMES = (
    "scheduled_departure",
    "scheduled_departure_local",
    "scheduled_arrival",
    "scheduled_arrival_local",
    "scheduled_duration",
    "actual_departure",
    "actual_departure_local",
    "actual_arrival",
    "actual_arrival_local",
    "actual_duration",
)
TICKET_FIELDS = (
    "ticket_no",
    "flight_id",
    "passenger_id",
    "passenger_name",
    "contact_data",
    "fare_conditions",
    "amount",
    "seat_no",
)


def values_where(value: str, condition: Column) -> Column:
    """Sorted array of ``value`` over the rows meeting ``condition``; NULL if there are none."""
    values = F.sort_array(F.collect_list(F.when(condition, F.col(value))))
    return F.when(F.size(values) > 0, values)


def aircraft_seat_document(
    aircraft: DataFrame,
    seats: DataFrame,
    *,
    classes: Mapping[str, str] = SEAT_CLASSES,
    part_size: int = PART_SIZE,
) -> DataFrame:
    """Each aircraft having seats, with one array of seat numbers per fare class.

    ``aircraft_code`` identifies an aircraft, ``seat_no`` a seat of it. A document holds
    ``part_size`` seats: ``part``, from 0, of ``parts``, in order of the seats. Runs jobs.
    """
    placed, parts = in_parts(seats, ["aircraft_code"], ["seat_no", "fare_conditions"], part_size)
    owners = owners_of_parts(aircraft.select("aircraft_code", "model", "range"), parts, ["aircraft_code"])
    # Seats meet their aircraft where they are grouped: one shuffle, by document.
    return placed.join(owners, ["aircraft_code", "part"]).groupBy(
        "aircraft_code", "model", "range", "part", "parts"
    ).agg(
        *[
            values_where("seat_no", F.col("fare_conditions") == fare).alias(name)
            for name, fare in classes.items()
        ]
    )


def _airport(role: str) -> Column:
    return F.struct(
        F.col(role).alias("airport_code"),
        F.col(f"{role}_name").alias("airport_name"),
        F.col(f"{role.removesuffix('_airport')}_city").alias("city"),
        F.col(f"{role}_info.coordinates").alias("coordinates"),
        F.col(f"{role}_info.timezone").alias("timezone"),
    ).alias(role)


def flight_document(
    flights: DataFrame,
    aircraft_documents: DataFrame,
    airports: DataFrame,
    *,
    classes: Mapping[str, str] = SEAT_CLASSES,
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Each flight with aircraft, departure airport, arrival airport and time objects.

    ``aircraft_documents`` is what ``aircraft_seat_document`` returns, preferably written
    and read back: joined as a plain table, a hot aircraft's flights can be split by
    adaptive execution. A flight has a document for each part of its aircraft.
    ``derived``: columns of a flight that follow from its others, made after the joins so that
    the shuffle by aircraft, which takes every flight, does not carry them.
    """
    aircraft = F.struct("aircraft_code", "model", "range", *classes)
    lookup = aircraft_documents.select("aircraft_code", "part", "parts", aircraft.alias("aircraft"))
    joined = flights.join(lookup, "aircraft_code")
    for role in ("departure_airport", "arrival_airport"):
        lookup = airports.select(
            F.col("airport_code").alias(role),
            F.struct("coordinates", "timezone").alias(f"{role}_info"),
        )
        joined = joined.join(lookup, role)
    return joined.withColumns(dict(derived or {})).select(
        "flight_id",
        "flight_no",
        "part",
        "parts",
        "aircraft",
        _airport("departure_airport"),
        _airport("arrival_airport"),
        F.struct(*FLIGHT_TIMES).alias("flight_time"),
        "status",
    )


def booking_document(
    bookings: DataFrame,
    tickets: DataFrame,
    ticket_flights: DataFrame,
    boarding_passes: DataFrame,
    *,
    part_size: int = PART_SIZE,
) -> DataFrame:
    """Each booking with an array of its tickets' flights, boarded or not.

    ``book_ref`` identifies a booking, (``ticket_no``, ``flight_id``) an array element. A document
    holds ``part_size`` elements: ``part``, from 0, of ``parts``, in order of the elements. Runs jobs.
    """
    elements = ticket_flights.join(boarding_passes, ["ticket_no", "flight_id"], "left").join(
        tickets, "ticket_no"
    )
    # Written, as it is read for the places of its rows and for the rows.
    elements = write_table(elements.select("book_ref", *TICKET_FIELDS), "ticket-elements")
    placed, parts = in_parts(elements, ["book_ref"], ["ticket_no", "flight_id"], part_size)
    owners = owners_of_parts(bookings.select("book_ref", "book_date", "total_amount"), parts, ["book_ref"])
    # Elements meet their booking where they are grouped: one shuffle, by document.
    grouped = placed.join(owners, ["book_ref", "part"]).groupBy(
        "book_ref", "part", "parts", "book_date", "total_amount"
    )
    return grouped.agg(F.sort_array(F.collect_list(F.struct(*TICKET_FIELDS))).alias("tickets"))


def written_documents(documents: DataFrame) -> DataFrame:
    """``documents`` as a table of known size, for joining into other documents."""
    return write_table(documents, "documents")


def write_collections(
    tables: Mapping[str, DataFrame],
    write: Callable[[DataFrame, str], None],
    *,
    classes: Mapping[str, str] = SEAT_CLASSES,
    part_size: int = PART_SIZE,
    derived: Mapping[str, Column] | None = None,
) -> None:
    """Build the three collections and give each, with its name, to ``write``.

    ``tables``: ``aircraft``, ``seats``, ``flights``, ``airports``, ``bookings``, ``tickets``,
    ``ticket_flights`` and ``boarding_passes``; ``derived``: of flights, as in ``flight_document``.
    """
    aircraft = written_documents(
        aircraft_seat_document(tables["aircraft"], tables["seats"], classes=classes, part_size=part_size)
    )
    write(aircraft, "aircrafts")
    flights = flight_document(tables["flights"], aircraft, tables["airports"], classes=classes, derived=derived)
    write(flights, "flights")
    bookings = booking_document(
        tables["bookings"],
        tables["tickets"],
        tables["ticket_flights"],
        tables["boarding_passes"],
        part_size=part_size,
    )
    write(bookings, "bookings")
