"""One row per registered customer: registration, home and number of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ridelake.functions.columns import sighting
from ridelake.functions.schema import enforce_schema
from ridelake.operators.mergeable import Entity, Part
from ridelake.schemas import CUSTOMERS
from ridelake.values import CUSTOMER_EVENTS

_REGISTERED, _REQUESTED = CUSTOMER_EVENTS


# No request is NULL, not 0. Requests without a user are no user's requests.
_REQUESTS = "IF(user_id IS NULL, NULL, nullif(requests, 0)) AS total_rides_requested"


def _finish(summary: DataFrame) -> DataFrame:
    customers = summary.filter("registration IS NOT NULL").selectExpr(
        "user_id",
        "registered_at AS registration_date",
        "registration.latitude AS home_location_lat",
        "registration.longitude AS home_location_long",
        _REQUESTS,
    )
    return enforce_schema(customers, CUSTOMERS)


CUSTOMER = Entity(
    name="customers",
    key="user_id",
    event_types=CUSTOMER_EVENTS,
    schema=CUSTOMERS,
    values={
        "place": sighting("latitude", "longitude"),
        "requested": f"CAST(event_type = '{_REQUESTED}' AS BIGINT)",
    },
    parts={
        "registered_at": Part("min", "event_timestamp", _REGISTERED),
        "registration": Part("min", "place", _REGISTERED),
        "requests": Part("sum", "requested"),
    },
    finish=_finish,
)
