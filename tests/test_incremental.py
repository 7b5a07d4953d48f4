"""Sums brought up to date from changed rows, against sums of all rows."""

from __future__ import annotations

import random

import pytest
from conftest import READ_EVENT, event, rows
from test_processing import random_events
from test_streaming import AS_OF, topic  # noqa: F401

from ridelake.operators import analytics
from ridelake.operators.incremental import BY_DRIVER, DAILY, HEATMAP, SUMS
from ridelake.plans import bronze, gold, jobs, silver
from ridelake.sources.lake import BUCKET
from ridelake.streaming.gold import refresh_ride_gold, sums_table
from ridelake.streaming.silver import Changed

WHOLE = {
    DAILY.name: analytics.daily_ride_metrics,
    HEATMAP.name: analytics.ride_geo_heatmap,
    BY_DRIVER.name: analytics.driver_ride_metrics,
}


def rides_of(spark, events):
    return silver.rides(spark.createDataFrame(events, READ_EVENT), AS_OF)


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_add_up_to_a_rebuild(spark, seed):
    """Rows that come, change, move to other groups and go, in any number of steps."""
    rng = random.Random(seed)
    events = random_events(seed, 160)
    rng.shuffle(events)
    tables = [rides_of(spark, events[:n]).checkpoint() for n in (0, 60, 110, 160, 90)]
    for sums in SUMS:
        kept = sums.of(tables[0])
        for old, new in zip(tables, tables[1:], strict=False):
            kept = sums.apply(kept, sums.change(old.exceptAll(new), new.exceptAll(old)))
            assert rows(sums.finish(kept)) == rows(WHOLE[sums.name](new)), sums.name
        assert sums.change(tables[1], tables[1]).count() == 0


def test_columns_are_those_of_the_tables(spark):
    rides = rides_of(spark, random_events(3, 20))
    for sums in SUMS:
        assert sums.finish(sums.of(rides)).dtypes == WHOLE[sums.name](rides).dtypes


def test_streamed_gold_equals_a_rebuild(spark, lake, topic):  # noqa: F811
    events = random_events(41, 120)
    random.Random(5).shuffle(events)
    for start in range(0, 120, 40):
        topic.send(events[start : start + 40])
        assert jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF) == []
        df = spark.createDataFrame(events[: start + 40], READ_EVENT)
        built = gold.build_all({name: silver.build(name, df, AS_OF) for name in silver.ENTITIES}, AS_OF)
        for name, expected in built.items():
            found = lake.read(spark, "gold", name)
            assert sorted(found.dtypes) == sorted(expected.dtypes)
            columns = sorted(expected.columns)
            assert rows(found.select(columns)) == rows(expected.select(columns)), name
    assert Changed(spark, lake, "rides").versions() == []


def test_only_changed_groups_are_read_and_written(spark, lake, topic, tmp_path):  # noqa: F811
    topic.send(random_events(42, 300))
    jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF)
    version = lake.version(spark, "gold", sums_table(DAILY))
    topic.send([event("ride_started", "2031-05-05", ride="far", driver="d")])
    jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF)
    after = lake.version(spark, "gold", sums_table(DAILY))
    written = list((tmp_path / "lake/gold" / sums_table(DAILY) / f"{after:012d}").glob(f"{BUCKET}=*"))
    assert after > version and len(written) == 1
    assert rows(lake.read(spark, "gold", DAILY.name).filter("ride_date = '2031-05-05'"), "total_rides") == [(1,)]


def test_refresh_of_gold_dies(spark, lake, topic, monkeypatch):  # noqa: F811
    """Between two tables and between two buckets; nothing is added twice."""
    events = random_events(43, 90)
    sql = spark.sql
    for start, allowed in ((0, None), (30, 4), (60, 1)):
        topic.send(events[start : start + 30])
        if allowed is None:
            assert jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF) == []
            continue
        left = [allowed]

        def dies(session, text, *args):
            if text.startswith("ALTER TABLE") and "_gold`" in text:
                left[0] -= 1
                if left[0] < 0:
                    raise RuntimeError("lost")
            return sql(text, *args)

        with monkeypatch.context() as patch:
            patch.setattr(type(spark), "sql", dies)
            with pytest.raises(RuntimeError, match="lost"):
                jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF)
    refresh_ride_gold(spark, lake)
    rides = silver.rides(bronze.read_events(spark, lake), AS_OF)
    for sums in SUMS:
        assert rows(lake.read(spark, "gold", sums.name)) == rows(WHOLE[sums.name](rides)), sums.name
