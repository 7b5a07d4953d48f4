"""Plans: what is read, how often it is shuffled."""

from __future__ import annotations

import re

import pytest
from conftest import READ_EVENT
from test_processing import random_events

from ridelake.functions.time import filter_time_range
from ridelake.operators import analytics
from ridelake.operators.drivers import latest_location
from ridelake.operators.quality import check_data_quality
from ridelake.plans import silver
from ridelake.schemas import EVENT


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "events")
    spark.createDataFrame(random_events(21, 100), READ_EVENT).write.parquet(path)
    return spark.read.parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return len(re.findall(r"\bExchange \w+", text))


@pytest.mark.parametrize("name", silver.ENTITIES)
def test_silver_is_one_filtered_scan_one_shuffle_no_join(events, name):
    text = plan(silver.build(name, events))
    assert text.count("FileScan") == 1
    assert "PushedFilters: [In(event_type" in text
    assert "event_data" not in text and "source" not in text.split("ReadSchema")[1]
    assert shuffles(text) == 1
    assert "Join" not in text and "Window" not in text
    # Rows are aggregated before the shuffle, so a hot key stays small.
    assert re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*Aggregate\([^\n]*partial_min", text)


def test_silver_shuffles_little_more_than_the_events(events):
    """One struct per event travels; one-value structs only where something is missing."""
    text = plan(silver.rides(events))
    assert len(re.findall(r"partial_min\(whole", text)) == 3


@pytest.mark.parametrize("ties", ["one", "all"])
def test_latest_location_is_aggregated_before_the_shuffle(events, ties):
    """With ties a join, which can be split at a driver with most rows, and no window, which can't."""
    text = plan(latest_location(events, ties))
    assert "partial_max" in text and "Window" not in text
    assert ("Join" in text) == (ties == "all")


def test_gold_reads_only_its_columns(spark, events, tmp_path):
    path = str(tmp_path / "rides")
    silver.rides(events).write.parquet(path)
    rides = spark.read.parquet(path)
    read = {
        "daily_ride_metrics": 4, "ride_geo_heatmap": 3, "driver_ride_metrics": 3, "last_ride_per_customer": 2,
    }
    for name, columns in read.items():
        text = plan(getattr(analytics, name)(rides))
        scan = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
        assert len(scan.split(",")) == columns, name
        assert shuffles(text) == 1
        # Fixed-width buffers only: no sort.
        assert "HashAggregate" in text and "SortAggregate" not in text


def test_quality_checks_are_one_scan(events):
    text = plan(check_data_quality(events, "events", EVENT, key="event_id"))
    assert text.count("FileScan") == 1
    assert "Expand" not in text


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_time_range_reaches_the_scan(spark, events, tmp_path, kind):
    path = str(tmp_path / "times")
    events.selectExpr(f"CAST(event_timestamp AS {kind}) AS t").write.parquet(path)
    text = plan(filter_time_range(spark.read.parquet(path), "t", "2024-01-01", "2024-01-02"))
    assert "GreaterThanOrEqual(t,2024-01-01" in text and "LessThanOrEqual(t,2024-01-02" in text
