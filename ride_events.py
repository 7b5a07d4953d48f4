"""A general event log, read as ride events.

The log has (event_id, ts, user_id, event_type, value, props) with event types
view, purchase, error, signup and click. Views, purchases and errors become ride
events, four consecutive ids being one ride; signups and clicks are split over
the driver and customer events by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EVENT_LOG = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

_EVENT_TYPE = """
    CASE event_type
      WHEN 'view' THEN 'ride_started'
      WHEN 'purchase' THEN 'ride_completed'
      WHEN 'error' THEN 'ride_cancelled'
      WHEN 'signup' THEN CASE event_id % 3
        WHEN 0 THEN 'customer_registered' WHEN 1 THEN 'driver_registered' ELSE 'driver_activated' END
      WHEN 'click' THEN CASE event_id % 2
        WHEN 0 THEN 'driver_location_update' ELSE 'customer_ride_request' END
    END
"""

# A few users with many events.
_USER = "CASE WHEN user_id % 3 = 0 THEN user_id % 10 ELSE user_id END"

# Some users are without rides, and of some the last ride is early: those events are requests.
_RIDE = "event_type IN ('view', 'purchase', 'error')"
_NO_RIDE = f"{_USER} % 7 = 1 OR ({_USER} % 4 = 0 AND ts >= TIMESTAMP_NTZ '2024-01-05 00:00:00')"


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT_LOG).parquet(path)


def events_as_rides(log: DataFrame) -> DataFrame:
    return log.selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        f"IF({_RIDE} AND ({_NO_RIDE}), 'customer_ride_request', {_EVENT_TYPE}) AS event_type",
        "CAST(ts AS TIMESTAMP) AS event_timestamp",
        f"CAST({_USER} AS STRING) AS user_id",
        "CAST((event_id DIV 4) % 40 AS STRING) AS driver_id",
        "CAST(event_id DIV 4 AS STRING) AS ride_id",
        "CAST(12.902 + 0.01 * (user_id % 20) AS DOUBLE) AS latitude",
        "CAST(77.502 + 0.01 * (event_id % 7) AS DOUBLE) AS longitude",
        "props AS event_data",
        "'app' AS source",
    )
