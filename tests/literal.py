"""The silver tables by plain SQL: pivot, rank and joins, for comparison.

Values come from the earliest event of a kind, as in the library, but with one
aggregate per value and one branch per part of the row.
"""

from __future__ import annotations


def _first(value: str, condition: str) -> str:
    return (
        f"min(struct(event_timestamp IS NULL AS timeless, event_timestamp AS at, event_id, {value})) "
        f"FILTER (WHERE {condition} AND {value} IS NOT NULL)"
    )


def _pivoted(kinds: tuple[str, ...]) -> str:
    columns = []
    for kind in kinds:
        for ending, value in (("timestamp", "event_timestamp"), ("lat", "latitude"), ("long", "longitude")):
            columns.append(f"{_first(value, f'event_type = {kind!r}')} AS {kind}_{ending}")
    return ", ".join(columns)


def _unpacked(kinds: tuple[str, ...]) -> str:
    columns = []
    for kind in kinds:
        for ending, value in (("timestamp", "event_timestamp"), ("lat", "latitude"), ("long", "longitude")):
            columns.append(f"{kind}_{ending}.{value} AS {kind}_{ending}")
    return ", ".join(columns)


_RIDES = ("ride_started", "ride_completed", "ride_cancelled")
_DRIVERS = ("driver_registered", "driver_activated")

RIDES = f"""
SELECT *, IF(ride_completed_timestamp IS NOT NULL,
    unix_timestamp(ride_completed_timestamp) - unix_timestamp(ride_started_timestamp), NULL) AS duration_seconds,
  DATE '2024-02-05' AS processing_date
FROM (
  SELECT ride_id, driver.driver_id AS driver_id, user.user_id AS user_id, {_unpacked(_RIDES)} FROM (
    SELECT ride_id, {_first("driver_id", "true")} AS driver, {_first("user_id", "true")} AS user, {_pivoted(_RIDES)}
    FROM {{events}} WHERE event_type IN {_RIDES} GROUP BY ride_id
  )
)
"""

DRIVERS = f"""
SELECT p.*, l.latitude, l.longitude
FROM (
  SELECT driver_id, {_unpacked(_DRIVERS)} FROM (
    SELECT driver_id, {_pivoted(_DRIVERS)}
    FROM {{events}} WHERE event_type IN {(*_DRIVERS, "driver_location_update")} GROUP BY driver_id
  )
) p LEFT JOIN (
  SELECT driver_id, latitude, longitude FROM (
    SELECT *, row_number() OVER (
      PARTITION BY driver_id
      ORDER BY event_timestamp DESC, event_id DESC, latitude DESC, longitude DESC) AS n
    FROM {{events}} WHERE event_type = 'driver_location_update'
  ) WHERE n = 1
) l ON p.driver_id = l.driver_id
"""

CUSTOMERS = """
SELECT p.user_id, p.registered_at AS registration_date, p.first.latitude AS home_location_lat,
  p.first.longitude AS home_location_long, r.total_rides_requested
FROM (
  SELECT user_id, min(event_timestamp) AS registered_at,
    min(struct(event_timestamp IS NULL AS timeless, event_timestamp AS at, event_id, latitude, longitude))
      AS first
  FROM {events} WHERE event_type = 'customer_registered' GROUP BY user_id
) p LEFT JOIN (
  SELECT user_id, count(*) AS total_rides_requested
  FROM {events} WHERE event_type = 'customer_ride_request' GROUP BY user_id
) r ON p.user_id = r.user_id
"""

QUERIES = {"rides": RIDES, "drivers": DRIVERS, "customers": CUSTOMERS}


def build(name: str, events):
    return events.sparkSession.sql(QUERIES[name], events=events)
