"""Tied last locations of a stream are those of the batch, in any slices, after restarts and crashes."""

from __future__ import annotations

import random

import pytest
from conftest import READ_EVENT, event, rows

from ridelake.operators.drivers import latest_location, location_updates
from ridelake.plans import bronze
from ridelake.sources import kafka, storage
from ridelake.sources.lake import Lake
from ridelake.streaming.bronze import start_bronze
from ridelake.streaming.locations import TABLE, bring_up_to_date, start_latest_locations
from ridelake.streaming.queries import await_all

NOW = {"availableNow": True}
SEEN = ("driver_id", "latitude", "longitude")


def updates(seed, number):
    """Few drivers and times, so that many are tied; some without a driver, time or place; late ones; repeated ones."""
    rng = random.Random(seed)
    times = [None, *[f"2024-01-0{day} 10:00:00" for day in range(1, 5)]]
    found = [
        event(
            rng.choice(["driver_location_update"] * 3 + ["driver_registered"]),
            rng.choice(times),
            driver=rng.choice([None, "hot", "hot", *"abcde"]),
            lat=rng.choice([None, 1.0, 2.0]),
            long=rng.choice([None, 3.0]),
        )
        for _ in range(number)
    ]
    return [*found, *rng.choices(found, k=number // 5)]


def table(spark, lake):
    return rows(lake.read(spark, "silver", TABLE), *SEEN)


def expected(spark, events):
    return rows(latest_location(spark.createDataFrame(events, READ_EVENT), ties="all"), *SEEN)


def test_stream_equals_batch_over_restarts(spark, lake, tmp_path):
    path, events = str(tmp_path / "topic"), updates(1, 90)
    for start, end in ((0, 60), (60, len(events))):
        kafka.pack(spark.createDataFrame(events[start:end], READ_EVENT)).selectExpr(
            "CAST(value AS BINARY) AS value"
        ).coalesce(1).write.mode("append").parquet(path)
        messages = spark.readStream.schema("value binary").parquet(path)
        assert await_all([start_bronze(bronze.parse_events(messages), lake, trigger=NOW)]) == []
        assert await_all([start_latest_locations(spark, lake, trigger=NOW, maxFilesPerTrigger="3")]) == []
        assert table(spark, lake) == expected(spark, events[:end])
    storage.delete(spark, lake.checkpoint("silver", TABLE))
    with pytest.raises(ValueError, match="checkpoint"):
        start_latest_locations(spark, lake, trigger=NOW)


class Crash(Exception):
    pass


@pytest.mark.parametrize("written", [False, True])
def test_batch_that_runs_again_counts_once(spark, lake, monkeypatch, written):
    events = updates(2, 60)
    parts = [location_updates(spark.createDataFrame(part, READ_EVENT)) for part in (events[:40], events[40:])]
    lake.create_bucketed(spark, "silver", TABLE, parts[0].schema)
    bring_up_to_date(lake, parts[0], 0)
    bring_up_to_date(lake, parts[0], 0)
    assert table(spark, lake) == expected(spark, events[:40])

    def crash(self, *args, **options):
        if written:
            own(self, *args, **options)
        raise Crash

    own = Lake._save
    with monkeypatch.context() as patched, pytest.raises(Crash):
        patched.setattr(Lake, "_save", crash)
        bring_up_to_date(lake, parts[1], 1)
    for _ in range(2):
        bring_up_to_date(lake, parts[1], 1)
        assert table(spark, lake) == expected(spark, events)


def test_only_buckets_of_a_batchs_drivers_are_written(spark, lake):
    make = lambda driver, when: location_updates(
        spark.createDataFrame([event("driver_location_update", when, driver=driver, lat=1.0, long=1.0)], READ_EVENT)
    )
    lake.create_bucketed(spark, "silver", TABLE, make("a", None).schema)
    for number, driver in enumerate("abca"):
        bring_up_to_date(lake, make(driver, f"2024-01-0{number + 1} 10:00:00"), number)
    written = storage.matching(spark, f"{lake.path('silver', TABLE)}/000000000003/_bucket=*")
    assert len(written) == 1 and len(table(spark, lake)) == 3
