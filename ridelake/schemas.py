"""Schemas of the three layers."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from ridelake.values import RIDE_EVENTS


def _fields(*specs: tuple) -> list[StructField]:
    return [StructField(name, kind, nullable) for name, kind, nullable in specs]


def _moment(prefix: str) -> list[StructField]:
    """When and where something first happened."""
    return _fields(
        (f"{prefix}_timestamp", TimestampType(), True),
        (f"{prefix}_lat", DoubleType(), True),
        (f"{prefix}_long", DoubleType(), True),
    )


# Nullability is what the producer promises. Readers of JSON and CSV make every
# field nullable, so the promise is checked by operators.quality, not by Spark.
EVENT = StructType(
    _fields(
        ("event_id", StringType(), False),
        ("event_type", StringType(), False),
        ("event_timestamp", TimestampType(), False),
        ("user_id", StringType(), True),
        ("driver_id", StringType(), True),
        ("ride_id", StringType(), True),
        ("latitude", DoubleType(), True),
        ("longitude", DoubleType(), True),
        ("event_data", StringType(), True),
        ("source", StringType(), False),
    )
)

DATE_PARTS = ("year", "month", "day")

BRONZE = StructType(
    EVENT.fields
    + _fields(("ingestion_timestamp", TimestampType(), True))
    + _fields(*[(part, IntegerType(), True) for part in DATE_PARTS])
)

RIDES = StructType(
    _fields(
        ("ride_id", StringType(), True),
        ("driver_id", StringType(), True),
        ("user_id", StringType(), True),
    )
    + [field for kind in RIDE_EVENTS for field in _moment(kind)]
    + _fields(
        ("duration_seconds", LongType(), True),
        ("processing_date", DateType(), True),
    )
)

DRIVERS = StructType(
    _fields(("driver_id", StringType(), True))
    + _moment("driver_registered")
    + _moment("driver_activated")
    + _fields(("latitude", DoubleType(), True), ("longitude", DoubleType(), True))
)

CUSTOMERS = StructType(
    _fields(
        ("user_id", StringType(), True),
        ("registration_date", TimestampType(), True),
        ("home_location_lat", DoubleType(), True),
        ("home_location_long", DoubleType(), True),
        ("total_rides_requested", LongType(), True),
    )
)

METRICS = StructType(
    _fields(
        ("dataset", StringType(), False),
        ("row_count", LongType(), False),
        ("processed_at", TimestampType(), False),
    )
)

STREAM_METRICS = StructType(
    _fields(
        ("query", StringType(), True),
        ("run_id", StringType(), False),
        ("batch_id", LongType(), True),
        ("input_rows", LongType(), False),
        ("batch_seconds", DoubleType(), True),
        ("failure", StringType(), True),
        ("observed_at", TimestampType(), False),
    )
)
