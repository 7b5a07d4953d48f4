"""The jobs end to end, and how their output lies in files."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import READ_EVENT, event, rows
from pyspark.sql import functions as F
from test_processing import random_events

from ridelake.plans import bronze, gold, jobs, silver

AS_OF = "2024-02-05"


@pytest.fixture
def history(spark, tmp_path):
    """Historical JSON files of random events."""

    def write(events):
        df = spark.createDataFrame(events, READ_EVENT)
        df.repartition(3).write.mode("append").json(str(tmp_path / "history" / "events"))
        return str(tmp_path / "history")

    return write


def gold_rows(df):
    return rows(df.select(sorted(df.columns)))


def test_run_batch(spark, lake, history):
    events = random_events(11, 200)
    path = history(events)
    counts = jobs.run_batch(spark, lake, path, as_of=AS_OF)

    df = spark.createDataFrame(events, READ_EVENT)
    tables = {name: silver.build(name, df, AS_OF) for name in silver.ENTITIES}
    for name, expected in tables.items():
        assert rows(lake.read(spark, "silver", f"historical_{name}")) == rows(expected)

    assert set(counts) == {
        "historical_ride_metrics", "historical_ride_geo_heatmap", "historical_driver_performance",
        "historical_driver_geo_distribution", "historical_customer_segments", "historical_customer_retention",
    }
    for name, count in counts.items():
        table = lake.read(spark, "gold", name)
        source = "daily_ride_metrics" if name == "historical_ride_metrics" else name.removeprefix("historical_")
        assert gold_rows(table) == gold_rows(gold.build(source, tables, AS_OF))
        assert table.count() == count
    assert rows(lake.read(spark, "gold", jobs.METRICS_TABLE), "dataset", "row_count") == sorted(
        counts.items(), key=repr
    )

    # Historical bronze is partitioned by the day of the run.
    assert rows(bronze.read_events(spark, lake, "historical_events").select("year", "month", "day").distinct()) == [
        (2024, 2, 5)
    ]


def test_run_batch_again(spark, lake, history):
    path = history(random_events(16, 40))
    for mode, runs in (("append", 1), ("append", 2), ("overwrite", 1)):
        jobs.run_batch(spark, lake, path, ["daily_ride_metrics"], ingest_mode=mode)
        assert bronze.read_events(spark, lake, "historical_events").count() == 40 * runs


def test_run_batch_with_some_gold_tables(spark, lake, history):
    path = history(random_events(12, 60))
    counts = jobs.run_batch(spark, lake, path, ["historical_ride_metrics", "historical_driver_performance"])
    assert set(counts) == {"historical_ride_metrics", "historical_driver_performance"}
    assert not lake.exists(spark, "gold", "historical_customer_segments")


def test_batch_needs_files(spark, lake, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.run_batch(spark, lake, str(tmp_path / "nowhere"))


def test_refresh_gold_from_the_silver_there_is(spark, lake):
    assert jobs.refresh_gold(spark, lake) == {}
    events = spark.createDataFrame(random_events(13, 60), READ_EVENT)
    silver.write_silver(silver.rides(events), lake, "rides")
    assert set(jobs.refresh_gold(spark, lake)) == {"daily_ride_metrics", "ride_geo_heatmap"}


def test_bronze_files_hold_event_types_in_order(spark, lake, history, tmp_path):
    path = history(random_events(14, 300))
    bronze.ingest_json(spark, lake, f"{path}/events/*.json", "events")
    files = list((tmp_path / "lake/bronze/events").rglob("*.parquet"))
    assert files
    for file in files:
        kinds = pq.ParquetFile(file).read(["event_type"]).column(0).to_pylist()
        assert kinds == sorted(kinds)


def test_gold_is_clustered_and_a_frequent_value_split(spark, lake, tmp_path):
    # All customers but a few are in one segment.
    customers = spark.range(20000).selectExpr(
        "CAST(id AS STRING) AS user_id", "CAST(IF(id < 50, 30, 1) AS BIGINT) AS total_rides_requested"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        seen = gold.write_gold(gold.build("customer_segments", {"customers": customers}), lake, "customer_segments")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert seen.get["row_count"] == 20000
    ranges = []
    for file in Path(lake.current(spark, "gold", "customer_segments").removeprefix("file:")).glob("*.parquet"):
        table = pq.ParquetFile(file).read(["customer_segment", "user_id"]).to_pylist()
        keys = [(row["customer_segment"], row["user_id"]) for row in table]
        assert keys == sorted(keys)
        assert len(keys) < 10000
        ranges.append((keys[0], keys[-1]))
    ranges.sort()
    assert len(ranges) == 4
    assert all(before[1] < after[0] for before, after in zip(ranges, ranges[1:]))


def test_small_tables_are_one_file(spark, lake, tmp_path):
    events = spark.createDataFrame(random_events(15, 200), READ_EVENT).repartition(8)
    silver.write_silver(silver.rides(events), lake, "rides")
    assert len(list(Path(lake.current(spark, "silver", "rides").removeprefix("file:")).glob("*.parquet"))) == 1


def test_unmapped_gold_table_is_not_clustered(spark):
    df = spark.range(3)
    assert gold.cluster(df, "ride_geo_heatmap") is df


def test_silver_write_keeps_columns(spark, lake):
    events = spark.createDataFrame([event("ride_started", "2024-01-01", ride="r")], READ_EVENT)
    silver.write_silver(silver.rides(events).withColumn("note", F.lit("x")), lake, "rides")
    silver.write_silver(silver.rides(events), lake, "rides")
    assert rows(lake.read(spark, "silver", "rides"), "ride_id", "note") == [("r", None)]
