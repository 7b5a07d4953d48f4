"""One row per ride: when and where it started, was completed or cancelled."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ridelake.functions.schema import enforce_schema
from ridelake.functions.time import AsOf, today
from ridelake.operators.mergeable import Entity
from ridelake.operators.moments import moment_parts, moment_values, moments
from ridelake.schemas import RIDES
from ridelake.values import RIDE_EVENTS

_PEOPLE = ("driver_id", "user_id")

# Whole seconds from start to completion; negative when completed first.
_DURATION = "unix_timestamp(ride_completed_timestamp) - unix_timestamp(ride_started_timestamp) AS duration_seconds"


def _finish(summary: DataFrame, as_of: AsOf = None) -> DataFrame:
    rides = summary.selectExpr("ride_id", *moments(RIDE_EVENTS, _PEOPLE), _DURATION)
    return enforce_schema(rides.withColumn("processing_date", today(as_of)), RIDES)


RIDE = Entity(
    name="rides",
    key="ride_id",
    event_types=RIDE_EVENTS,
    schema=RIDES,
    values=moment_values(_PEOPLE),
    parts=moment_parts(RIDE_EVENTS, _PEOPLE),
    finish=_finish,
)
