"""The gold tables, each a function of silver tables.

Every join here is on a key that is unique on both sides (rides are aggregated to
the key first), so a hot driver or customer cannot blow up a join task; whether a
side is small enough to broadcast is left to Spark's own size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions.columns import grid, share, tier
from ridelake.functions.time import AsOf, days_since
from ridelake.values import (
    DRIVER_STATUS_BELOW,
    DRIVER_STATUS_ELSE,
    RETENTION_BELOW,
    RETENTION_ELSE,
    SEGMENT_ABOVE,
    SEGMENT_ELSE,
)


def _rides() -> Column:
    return F.count(F.lit(1))


def _cancelled() -> Column:
    return F.count_if(F.col("ride_cancelled_timestamp").isNotNull())


def daily_ride_metrics(rides: DataFrame) -> DataFrame:
    """Per start date and driver: rides, total and average duration, cancellations."""
    date = F.to_date("ride_started_timestamp").alias("ride_date")
    daily = rides.groupBy(date, "driver_id").agg(
        _rides().alias("total_rides"),
        F.sum("duration_seconds").alias("total_duration"),
        F.avg("duration_seconds").alias("avg_duration"),
        _cancelled().alias("cancelled_rides"),
    )
    return daily.withColumn("cancellation_rate", share("cancelled_rides", "total_rides"))


def ride_geo_heatmap(rides: DataFrame) -> DataFrame:
    """Per grid cell of the start: rides and average duration."""
    cell = (
        grid("ride_started_lat").alias("start_lat_rounded"),
        grid("ride_started_long").alias("start_long_rounded"),
    )
    return rides.groupBy(*cell).agg(_rides().alias("ride_count"), F.avg("duration_seconds").alias("avg_duration"))


def driver_ride_metrics(rides: DataFrame) -> DataFrame:
    """Per driver: rides, average duration, cancellations."""
    return rides.groupBy("driver_id").agg(
        _rides().alias("total_rides"),
        F.avg("duration_seconds").alias("avg_ride_duration"),
        _cancelled().alias("cancelled_rides"),
    )


def driver_performance(drivers: DataFrame, rides: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Drivers with their ride metrics (NULL without rides), rate and status."""
    return with_ride_metrics(drivers, driver_ride_metrics(rides), as_of)


def with_ride_metrics(drivers: DataFrame, metrics: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Drivers with metrics that have been counted already."""
    days_active = days_since("driver_activated_timestamp", as_of)
    return drivers.join(metrics, "driver_id", "left").withColumns(
        {
            "cancellation_rate": share("cancelled_rides", "total_rides"),
            "active_status": tier(days_active, DRIVER_STATUS_BELOW, DRIVER_STATUS_ELSE, above=False),
        }
    )


def driver_geo_distribution(drivers: DataFrame) -> DataFrame:
    """Drivers per grid cell of their current location."""
    cell = (grid("latitude").alias("lat_rounded"), grid("longitude").alias("long_rounded"))
    return drivers.groupBy(*cell).agg(F.count(F.lit(1)).alias("driver_count"))


def customer_segments(customers: DataFrame) -> DataFrame:
    """Customers with their segment by number of requests."""
    segment = tier(F.col("total_rides_requested"), SEGMENT_ABOVE, SEGMENT_ELSE, above=True)
    return customers.withColumn("customer_segment", segment)


def last_ride_per_customer(rides: DataFrame) -> DataFrame:
    """Start of each customer's last ride."""
    return rides.groupBy("user_id").agg(F.max("ride_started_timestamp").alias("last_ride_date"))


def customer_retention(customers: DataFrame, rides: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Customers with their last ride, the days since, and the retention status."""
    idle = days_since("last_ride_date", as_of)
    return customers.join(last_ride_per_customer(rides), "user_id", "left").withColumns(
        {
            "days_since_last_ride": idle,
            "retention_status": tier(idle, RETENTION_BELOW, RETENTION_ELSE, above=False),
        }
    )
