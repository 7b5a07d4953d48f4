"""The stream gives what the batch gives, in any slices and across restarts."""

from __future__ import annotations

import datetime as dt
import random
from pathlib import Path

import pytest
from conftest import READ_EVENT, event, rows
from pyspark.sql import functions as F
from test_processing import random_events

from ridelake.operators.dedup import dedup_events, first_deliveries
from ridelake.plans import bronze, jobs, silver
from ridelake.schemas import BRONZE
from ridelake.sources import kafka, storage
from ridelake.sources.lake import STREAM_BATCH
from ridelake.streaming.bronze import start_bronze, start_sorted_bronze
from ridelake.streaming.queries import await_all, stop_all
from ridelake.streaming import silver as streamed
from ridelake.streaming.silver import Changes, publish_silver, rebuild_silver, start_silver

AS_OF = "2024-02-05"
NOW = {"availableNow": True}


@pytest.fixture
def topic(spark, tmp_path):
    """A stream of messages read from files, one file per ``send``."""
    path = str(tmp_path / "topic")
    storage.make_dirs(spark, path)

    class Topic:
        def send(self, events):
            df = spark.createDataFrame(events, READ_EVENT)
            kafka.pack(df).select(F.col("value").cast("binary")).coalesce(1).write.mode("append").parquet(path)

        def stream(self):
            return spark.readStream.schema("value binary").option("maxFilesPerTrigger", 1).parquet(path)

    return Topic()


def silver_rows(spark, lake):
    return {name: rows(lake.read(spark, "silver", name)) for name in silver.ENTITIES}


def batch_rows(spark, events):
    df = spark.createDataFrame(events, READ_EVENT)
    return {name: rows(silver.build(name, df, AS_OF)) for name in silver.ENTITIES}


def test_stream_equals_batch_over_restarts(spark, lake, topic):
    events = random_events(5, 90)
    random.Random(1).shuffle(events)
    for start, end in ((0, 40), (40, 70), (70, 90)):
        topic.send(events[start : start + 10])
        topic.send(events[start + 10 : end])
        assert jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF, maxFilesPerTrigger="3") == []
        assert silver_rows(spark, lake) == batch_rows(spark, events[:end])
    assert rows(bronze.read_events(spark, lake), "event_id") == sorted(((e[0],) for e in events), key=repr)
    metrics = lake.read(spark, "gold", jobs.METRICS_TABLE)
    counts = rows(metrics.groupBy("dataset").agg(F.count("*"), F.max_by("row_count", "processed_at")))
    assert [count[1] for count in counts] == [3] * 6
    for name, _, last in counts:
        assert last == lake.read(spark, "gold", name).count()


def test_crash_after_a_batch_was_added(spark, lake, topic, monkeypatch):
    """The stream dies before it notes the batch as done, and runs it again."""
    events = random_events(9, 60)
    topic.send(events[:30])
    assert jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF) == []
    topic.send(events[30:])

    add = Changes.add

    def add_and_die(changes, *args):
        add(changes, *args)
        raise RuntimeError("lost")

    monkeypatch.setattr(Changes, "add", add_and_die)
    assert len(jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF)) == 3
    monkeypatch.undo()
    assert jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF) == []
    assert silver_rows(spark, lake) == batch_rows(spark, events)


def test_gold_refreshes_while_streaming(spark, lake, topic):
    topic.send(random_events(6, 30))
    queries = jobs.start_streaming(spark, lake, topic.stream(), {"processingTime": "100 milliseconds"})
    try:
        for query in queries:
            query.processAllAvailable()
        jobs.refresh(spark, lake, AS_OF)
        first = silver_rows(spark, lake)
        topic.send(random_events(7, 30))
        for query in queries:
            query.processAllAvailable()
        jobs.refresh(spark, lake, AS_OF)
    finally:
        stop_all(queries)
    assert not any(query.isActive for query in queries)
    assert await_all(queries) == []
    everything = bronze.read_events(spark, lake)
    assert silver_rows(spark, lake) == {n: rows(silver.build(n, everything, AS_OF)) for n in silver.ENTITIES} != first


def test_failed_query_is_left_out(spark, tmp_path):
    numbers = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()

    def fail(batch, batch_id):
        raise RuntimeError("no")

    broken = numbers.writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "c")).start()
    assert await_all([broken], poll_seconds=1) == [broken]


def test_stream_bronze_is_partitioned_by_event_date(spark, lake, topic, tmp_path):
    topic.send([event("ride_started", "2024-03-09", ride="r"), event("ride_started", None, ride="s")])
    jobs.run_streaming(spark, lake, topic.stream())
    assert (tmp_path / "lake/bronze/events/year=2024/month=3/day=9").is_dir()
    table = bronze.read_events(spark, lake)
    assert set(table.columns) == set(BRONZE.names)
    assert rows(table, "ride_id", "year") == [("r", 2024), ("s", None)]
    with pytest.raises(ValueError, match="written by a stream"):
        lake.compact(spark, "bronze", "events")
    with pytest.raises(ValueError, match="written by a stream"):
        lake.write(table, "bronze", "events")


def test_stream_does_not_hide_a_batch_table(spark, lake, topic):
    lake.write(spark.range(3).withColumn("year", F.lit(2024)), "bronze", "events", partition_by=["year"])
    with pytest.raises(ValueError, match="files of a batch job"):
        jobs.run_streaming(spark, lake, topic.stream())


def test_lost_checkpoint_is_an_error(spark, lake, topic, tmp_path):
    topic.send(random_events(8, 10))
    jobs.run_streaming(spark, lake, topic.stream())
    with pytest.raises(ValueError, match="count events twice"):
        start_silver(spark, lake, silver.entity_named("rides"), checkpoint_location=str(tmp_path / "elsewhere"))


def test_no_stream_yet(spark, lake):
    for entity in silver.ENTITIES.values():
        publish_silver(spark, lake, entity)
        assert rows(lake.read(spark, "silver", entity.name)) == []


# -- changes ------------------------------------------------------------------


def of_many_slices(spark, lake, topic, seed, n=60, slices=6, **options):
    """Streams of events that come in any order, some of them late by all of the table's history."""
    events = random_events(seed, n)
    random.Random(seed).shuffle(events)
    size = -(-n // slices)
    for start in range(0, n, size):
        topic.send(events[start : start + size])
    assert jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF, maxFilesPerTrigger="1", **options) == []
    return events


@pytest.mark.parametrize("seed", [31, 32])
def test_late_events_in_random_slices(spark, lake, topic, seed):
    events = of_many_slices(spark, lake, topic, seed)
    assert silver_rows(spark, lake) == batch_rows(spark, events)
    changes = Changes(spark, lake, silver.entity_named("rides"))
    assert changes.published == changes.batches()[-1] > 2


def test_only_touched_buckets_are_written(spark, lake, topic, monkeypatch):
    of_many_slices(spark, lake, topic, 33, 200)
    ride = silver.entity_named("rides")
    before = Path(lake.path("silver", "rides"))
    version = lake.version(spark, "silver", "rides")
    more = [event("ride_completed", "2024-01-09", ride="one more"), event("ride_completed", "2024-01-09", ride=None)]
    topic.send(more)
    jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF)
    after = lake.version(spark, "silver", "rides")
    assert after > version
    buckets = {row[0] for row in spark.createDataFrame(more, READ_EVENT).select(streamed.bucket_of("ride_id")).collect()}
    assert {int(p.name.split("=")[1]) for p in before.glob(f"{after:012d}/*=*")} == buckets
    everything = bronze.read_events(spark, lake)
    assert rows(lake.read(spark, "silver", "rides")) == rows(ride.build(everything, as_of=AS_OF))


def test_publisher_dies_anywhere(spark, lake, topic, monkeypatch):
    """Before the rows are written, between two buckets, and before the version is set; more comes in between."""
    events = random_events(34, 90)
    topic.send(events[:30])
    assert jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF) == []
    sql = spark.sql
    for start, statements in ((30, 0), (50, 5), (70, 9)):
        topic.send(events[start : start + 20])
        left = [statements]

        def dies(session, text, *args):
            if text.startswith("ALTER TABLE"):
                left[0] -= 1
                if left[0] < 0:
                    raise RuntimeError("lost")
            return sql(text, *args)

        with monkeypatch.context() as patch:
            patch.setattr(type(spark), "sql", dies)
            with pytest.raises(RuntimeError, match="lost"):
                jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF)
    assert jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF) == []
    jobs.refresh(spark, lake, AS_OF)
    assert silver_rows(spark, lake) == batch_rows(spark, events)


def test_lost_table_is_rebuilt_from_state(spark, lake, topic):
    events = of_many_slices(spark, lake, topic, 35)
    expected = batch_rows(spark, events)
    for name, entity in silver.ENTITIES.items():
        spark.sql(f"DROP TABLE {lake.table('silver', name)}")
        with pytest.raises(ValueError, match="rebuild_silver"):
            publish_silver(spark, lake, entity)
        rebuild_silver(spark, lake, entity, as_of=AS_OF)
        assert rows(lake.read(spark, "silver", name)) == expected[name]
        assert not publish_silver(spark, lake, entity)
    more = random_events(36, 30)
    topic.send(more)
    assert jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF) == []
    assert silver_rows(spark, lake) == batch_rows(spark, events + more)


def test_redelivered_events_count_once(spark, lake, topic):
    events = random_events(37, 60)
    again = events + random.Random(1).choices(events, k=40)
    random.Random(2).shuffle(again)
    for start in range(0, 100, 25):
        topic.send(again[start : start + 25])
    assert jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF, deduplicate=True, maxFilesPerTrigger="2") == []
    assert silver_rows(spark, lake) == batch_rows(spark, events)
    rebuild_silver(spark, lake, silver.entity_named("customers"))
    assert rows(lake.read(spark, "silver", "customers")) == batch_rows(spark, events)["customers"]
    df = spark.createDataFrame(again, READ_EVENT)
    assert rows(dedup_events(df)) == rows(spark.createDataFrame(events, READ_EVENT))


def test_first_of_an_id_by_time_and_all_without(spark, frame):
    late, early = event("a", "2024-01-02", id="x"), event("b", "2024-01-01", id="x")
    timeless, nameless = event("c", None, id="x"), event("d", "2024-01-01", id=None)[1:]
    df = frame(late, early, timeless, (None, *nameless), (None, *nameless))
    assert rows(dedup_events(df), "event_type") == [("b",), ("d",), ("d",)]
    assert rows(dedup_events(frame(timeless)), "event_type") == [("c",)]
    assert rows(dedup_events(frame())) == []


def test_ids_within_a_watermark(spark, topic, tmp_path):
    """Ids are forgotten when event times have moved on."""
    days = [("x", "2024-01-01"), ("x", "2024-01-01"), ("y", "2024-01-20"), ("x", "2024-01-20"), ("x", "2024-01-20")]
    for id, when in days:
        topic.send([event("ride_started", when, id=id)])
    events = bronze.parse_events(topic.stream())
    query = first_deliveries(events, within="2 days").writeStream.format("parquet").option("path", str(tmp_path / "out"))
    query = query.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert await_all([query]) == []
    found = rows(spark.read.parquet(str(tmp_path / "out")), "event_id", "day")
    assert ("x", 1) in found and found.count(("x", 1)) == 1 and found.count(("y", 20)) == 1


# -- the job --------------------------------------------------------------------


def test_nothing_new_is_not_published_again(spark, lake, topic):
    topic.send(random_events(4, 30))
    jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF)
    first = [lake.version(spark, "silver", name) for name in silver.ENTITIES]
    assert not any(publish_silver(spark, lake, entity, AS_OF) for entity in silver.ENTITIES.values())
    assert [lake.version(spark, "silver", name) for name in silver.ENTITIES] == first
    # What hasn't changed was processed when it was.
    publish_silver(spark, lake, silver.entity_named("rides"), "2024-02-06")
    assert rows(lake.read(spark, "silver", "rides").select("processing_date").distinct()) == [(dt.date(2024, 2, 5),)]


def test_failing_refresh_stops_the_queries(spark, lake, topic, monkeypatch):
    topic.send(random_events(3, 20))

    def fail(*_):
        raise RuntimeError("no refresh")

    monkeypatch.setattr(jobs, "refresh", fail)
    with pytest.raises(RuntimeError, match="no refresh"):
        jobs.run_streaming(spark, lake, topic.stream(), {"processingTime": "100 milliseconds"}, refresh_seconds=0)
    assert not spark.streams.active


def test_nothing_is_published_after_a_failure(spark, lake, topic, monkeypatch):
    topic.send(random_events(3, 20))

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(Changes, "add", fail)
    for trigger in (None, {"processingTime": "100 milliseconds"}):
        assert jobs.run_streaming(spark, lake, topic.stream(), trigger)
        assert not spark.streams.active
        assert not lake.exists(spark, "gold", jobs.METRICS_TABLE)


def test_sorted_bronze_equals_batch_and_its_batches_are_whole(spark, lake, topic):
    events = random_events(6, 90)
    for start, end in ((0, 50), (50, 90)):
        topic.send(events[start : start + 10])
        topic.send(events[start + 10 : end])
        failed = jobs.run_streaming(spark, lake, topic.stream(), as_of=AS_OF, bronze_writer=start_sorted_bronze)
        assert failed == []
        assert silver_rows(spark, lake) == batch_rows(spark, events[:end])
    read = bronze.read_events(spark, lake)
    assert set(read.columns) == set(BRONZE.fieldNames())
    assert sorted(storage.subdirectories(spark, lake.path("bronze", "events"))) == [
        *[f"{STREAM_BATCH}={i}" for i in range(4)],
        "_writing",
    ]
    for name in storage.matching(spark, f"{lake.path('bronze', 'events')}/*/year=*/month=*/day=*/*.parquet"):
        kinds = [row.event_type or "" for row in spark.read.parquet(name).select("event_type").collect()]
        assert kinds == sorted(kinds)
    with pytest.raises(ValueError, match="written by a stream"):
        lake.write(read, "bronze", "events")
    with pytest.raises(ValueError, match="read rewritten files again"):
        lake.compact(spark, "bronze", "events")
    with pytest.raises(ValueError, match="another writer"):
        start_bronze(bronze.parse_events(topic.stream()), lake)
    storage.delete(spark, lake.checkpoint("bronze", "events"))
    with pytest.raises(ValueError, match="belong to a checkpoint"):
        start_sorted_bronze(bronze.parse_events(topic.stream()), lake)


@pytest.mark.parametrize("when", ["before it appears", "after it appeared"])
def test_a_bronze_batch_that_runs_again_counts_once(spark, lake, topic, monkeypatch, when):
    events = random_events(7, 60)
    topic.send(events[:30])
    topic.send(events[30:])
    move, calls = storage.move, []

    def dies_once(spark, path, to):
        calls.append(to)
        if len(calls) == 2:
            if when == "after it appeared":
                move(spark, path, to)
            raise OSError("executor and driver are lost")
        move(spark, path, to)

    monkeypatch.setattr(storage, "move", dies_once)
    parsed = bronze.parse_events(topic.stream())
    assert len(await_all([start_sorted_bronze(parsed, lake, trigger=NOW)])) == 1
    silver_now = [start_silver(spark, lake, entity, trigger=NOW) for entity in silver.ENTITIES.values()]
    assert await_all(silver_now) == []  # a reader between the crash and the restart
    assert await_all([start_sorted_bronze(parsed, lake, trigger=NOW)]) == []
    ids = rows(bronze.read_events(spark, lake), "event_id")
    assert ids == sorted(((e[0],) for e in events), key=repr)
    assert await_all([start_silver(spark, lake, entity, trigger=NOW) for entity in silver.ENTITIES.values()]) == []
    for entity in silver.ENTITIES.values():
        publish_silver(spark, lake, entity, AS_OF)
    assert silver_rows(spark, lake) == batch_rows(spark, events)
