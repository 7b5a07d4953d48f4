"""Gold tables."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import at, naive, rows

from ridelake.operators import analytics
from ridelake.plans import gold
from ridelake.schemas import CUSTOMERS, DRIVERS, RIDES

AS_OF = "2024-02-05"


@pytest.fixture
def table(spark):
    """A silver table from dicts; columns not given are NULL."""

    def make(schema, *given):
        return spark.createDataFrame([tuple(row.get(name) for name in schema.names) for row in given], schema)

    return make


def ride(started=None, cancelled=None, **values):
    return {
        "ride_started_timestamp": started and at(started),
        "ride_cancelled_timestamp": cancelled and at(cancelled),
        **values,
    }


def test_daily_ride_metrics(table):
    rides = table(
        RIDES,
        ride("2024-01-01 23:59:59", driver_id="d", duration_seconds=10),
        ride("2024-01-01 00:00:00", "2024-01-01 01:00:00", driver_id="d"),
        ride("2024-01-01 12:00:00", driver_id="d", duration_seconds=20),
        ride("2024-01-02 00:00:00", driver_id="d"),
        ride(cancelled="2024-01-02", driver_id="d"),
        ride("2024-01-02 00:00:00", duration_seconds=-5),
    )
    day = dt.date(2024, 1, 1)
    assert rows(analytics.daily_ride_metrics(rides)) == sorted(
        [
            # Rides without a duration count, but not in its sum and average.
            (day, "d", 3, 30, 15.0, 1, 1 / 3),
            (dt.date(2024, 1, 2), "d", 1, None, None, 0, 0.0),
            (dt.date(2024, 1, 2), None, 1, -5, -5.0, 0, 0.0),
            (None, "d", 1, None, None, 1, 1.0),
        ],
        key=repr,
    )
    types = dict(analytics.daily_ride_metrics(rides).dtypes)
    assert types == {
        "ride_date": "date", "driver_id": "string", "total_rides": "bigint", "total_duration": "bigint",
        "avg_duration": "double", "cancelled_rides": "bigint", "cancellation_rate": "double",
    }


def test_ride_geo_heatmap(table):
    rides = table(
        RIDES,
        ride(ride_started_lat=12.904, ride_started_long=77.5, duration_seconds=4),
        ride(ride_started_lat=12.896, ride_started_long=77.504, duration_seconds=8),
        ride(ride_started_lat=1.005, ride_started_long=-1.005),
        ride(),
    )
    assert rows(analytics.ride_geo_heatmap(rides)) == [
        (1.01, -1.01, 1, None), (12.9, 77.5, 2, 6.0), (None, None, 1, None),
    ]


def test_driver_performance(table):
    drivers = table(
        DRIVERS,
        {"driver_id": "busy", "driver_activated_timestamp": at("2024-01-06 23:59:59")},
        {"driver_id": "idle", "driver_activated_timestamp": at("2024-01-07 00:00:00")},
        {"driver_id": "waiting"},
        {"driver_id": None},
    )
    rides = table(
        RIDES,
        ride("2024-01-01", "2024-01-01", driver_id="busy", duration_seconds=7),
        ride("2024-01-02", driver_id="busy"),
        ride("2024-01-02"),
    )
    performance = analytics.driver_performance(drivers, rides, AS_OF)
    columns = (
        "driver_id", "total_rides", "avg_ride_duration", "cancelled_rides", "cancellation_rate", "active_status",
    )
    assert rows(performance, *columns) == sorted(
        [
            ("busy", 2, 7.0, 1, 0.5, "active"),
            # 29 days by the calendar; no rides is NULL, not 0.
            ("idle", None, None, None, None, "new"),
            ("waiting", None, None, None, None, "active"),
            (None, None, None, None, None, "active"),
        ],
        key=repr,
    )
    assert performance.columns == [*DRIVERS.names, *columns[1:]]


def test_driver_geo_distribution(table):
    drivers = table(
        DRIVERS,
        {"driver_id": "a", "latitude": 1.001, "longitude": 2.004},
        {"driver_id": "b", "latitude": 0.999, "longitude": 1.996},
        {"driver_id": "c"},
    )
    assert rows(analytics.driver_geo_distribution(drivers)) == [(1.0, 2.0, 2), (None, None, 1)]


@pytest.mark.parametrize(
    ("requests", "segment"),
    [(None, "occasional"), (5, "occasional"), (6, "regular"), (20, "regular"), (21, "frequent")],
)
def test_customer_segments(table, requests, segment):
    customers = table(CUSTOMERS, {"user_id": "u", "total_rides_requested": requests})
    assert rows(analytics.customer_segments(customers), "customer_segment") == [(segment,)]


@pytest.mark.parametrize(
    ("last", "days", "status"),
    [
        ("2024-01-30 00:00:00", 6, "active"),
        ("2024-01-29 23:59:59", 7, "lapsing"),
        ("2024-01-07 00:00:00", 29, "lapsing"),
        ("2024-01-06 23:59:59", 30, "churned"),
        (None, None, "churned"),
    ],
)
def test_customer_retention(table, last, days, status):
    customers = table(CUSTOMERS, {"user_id": "u"})
    rides = table(RIDES, ride(last, user_id="u"), ride("2023-01-01", user_id="u") if last else {}, ride("2024-02-04"))
    retention = analytics.customer_retention(customers, rides, AS_OF)
    expected = last and naive(last)
    assert rows(retention, "last_ride_date", "days_since_last_ride", "retention_status") == [(expected, days, status)]
    assert retention.columns == [*CUSTOMERS.names, "last_ride_date", "days_since_last_ride", "retention_status"]


def test_reporting_date_defaults_to_today(spark, table):
    now = spark.sql("SELECT current_timestamp()").first()[0].astimezone(dt.timezone.utc)
    customers = table(CUSTOMERS, {"user_id": "u"})
    rides = table(RIDES, {"user_id": "u", "ride_started_timestamp": now})
    assert rows(analytics.customer_retention(customers, rides), "days_since_last_ride") in ([(0,)], [(1,)])


def test_build_all_needs_the_silver_tables(table):
    silver = {"rides": table(RIDES), "drivers": table(DRIVERS), "customers": table(CUSTOMERS)}

    def built(*names):
        return set(gold.build_all({name: silver[name] for name in names}))

    of_rides = {"daily_ride_metrics", "ride_geo_heatmap"}
    of_drivers = {"driver_performance", "driver_geo_distribution"}
    of_customers = {"customer_segments", "customer_retention"}
    assert built("rides") == of_rides
    assert built("drivers") == built("customers") == built("drivers", "customers") == set()
    assert built("rides", "drivers") == of_rides | of_drivers
    assert built("rides", "customers") == of_rides | of_customers
    assert built("rides", "drivers", "customers") == set(gold.NAMES)


def test_aliases(table):
    silver = {"rides": table(RIDES, ride("2024-01-01"))}
    for alias in ("ride_metrics", "historical_ride_metrics"):
        assert gold.build(alias, silver).columns == gold.build("daily_ride_metrics", silver).columns
        assert gold.cluster_columns(alias) == ("ride_date", "driver_id")
    assert gold.cluster_columns("ride_geo_heatmap") == ()
    with pytest.raises(ValueError, match="no gold table"):
        gold.build("weekly", silver)
