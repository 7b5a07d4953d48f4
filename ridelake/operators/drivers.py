"""One row per driver: registration, activation and current location."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.functions.columns import event_is, latest_sighting
from ridelake.functions.schema import enforce_schema
from ridelake.operators.mergeable import Entity, Part
from ridelake.operators.moments import PLACE, moment_parts, moment_values, moments
from ridelake.schemas import DRIVERS
from ridelake.values import DRIVER_EVENTS

_KINDS = ("driver_registered", "driver_activated")
_LOCATED = "driver_location_update"
_PLACE = tuple(PLACE.values())


def _finish(summary: DataFrame) -> DataFrame:
    # Events without a driver form a row of their own, but nobody's location.
    location = [f"IF(driver_id IS NULL, NULL, location.{value}) AS {value}" for value in _PLACE]
    return enforce_schema(summary.selectExpr("driver_id", *moments(_KINDS), *location), DRIVERS)


DRIVER = Entity(
    name="drivers",
    key="driver_id",
    event_types=DRIVER_EVENTS,
    schema=DRIVERS,
    values={**moment_values(), "located": latest_sighting(*_PLACE)},
    parts={**moment_parts(_KINDS), "location": Part("max", "located", _LOCATED)},
    finish=_finish,
)


def location_updates(events: DataFrame) -> DataFrame:
    """(driver_id, event_timestamp, latitude, longitude) of each location update."""
    return events.filter(event_is(_LOCATED)).select("driver_id", "event_timestamp", *_PLACE)


def last_updates(updates: DataFrame) -> DataFrame:
    """Of each driver those updates that have the latest time; those of some parts put together, these of the whole."""
    # Joined on driver and time, not ranked in a window, so that Spark can split a driver with most of the rows.
    last = updates.groupBy(F.col("driver_id").alias("_driver")).agg(F.max("event_timestamp").alias("_at"))
    same = F.col("driver_id").eqNullSafe(F.col("_driver")) & F.col("event_timestamp").eqNullSafe(F.col("_at"))
    return updates.join(last, same).drop("_driver", "_at")


def latest_location(events: DataFrame, ties: str = "one") -> DataFrame:
    """(driver_id, latitude, longitude) of each driver's last location update.

    ``ties="all"`` gives every update with the latest time, ``"one"`` the one
    with the greatest event_id.
    """
    updates = events.filter(event_is(_LOCATED))
    if ties == "one":
        last = updates.groupBy("driver_id").agg(F.max(F.expr(latest_sighting(*_PLACE))).alias("location"))
        return last.select("driver_id", *[f"location.{value}" for value in _PLACE])
    if ties == "all":
        return last_updates(updates).select("driver_id", *_PLACE)
    raise ValueError(f"ties must be 'one' or 'all', not {ties!r}")
