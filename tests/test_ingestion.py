"""Sources, schema helpers, time helpers, bronze and tables."""

from __future__ import annotations

import json
from pathlib import Path

import hypothesis
import pyarrow.parquet as pq
import pytest
from conftest import READ_EVENT, event, naive, rows
from hypothesis import HealthCheck, given
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ridelake import settings
from ridelake.functions.schema import common_type, enforce_schema, merge_schemas, parse_json, validate_schema
from ridelake.functions.time import add_ingest_metadata, add_time_periods, filter_time_range
from ridelake.operators.quality import check_data_quality, counted, row_counts
from ridelake.plans import bronze
from ridelake.schemas import BRONZE, EVENT
from ridelake.sources import files, kafka
from ridelake.sources.lake import BUCKET, Lake
from ridelake.streaming.bronze import start_bronze, start_quarantine
from ridelake.streaming.queries import await_all


def data_files(path):
    return sorted(p for p in path.rglob("*.parquet") if not any(part.startswith("_") for part in p.parts))


# -- parsing ------------------------------------------------------------------

FULL = {
    "event_id": "e1", "event_type": "ride_started", "event_timestamp": "2024-03-09T10:11:12.123456Z",
    "user_id": "u", "driver_id": "d", "ride_id": "r", "latitude": 1.5, "longitude": 2.5,
    "event_data": "x", "source": "app",
}


@pytest.mark.parametrize(
    ("message", "expected"),
    [
        (json.dumps(FULL), {"event_id": "e1", "latitude": 1.5, "year": 2024, "month": 3, "day": 9}),
        ("no json", {"event_id": None, "source": None, "year": None}),
        (None, {"event_id": None, "source": None, "year": None}),
        (json.dumps({**FULL, "event_timestamp": "soon"}), {"event_id": "e1", "event_timestamp": None, "year": None}),
        (json.dumps({**FULL, "latitude": "north"}), {"event_id": "e1", "latitude": None, "longitude": 2.5}),
        (json.dumps({**FULL, "colour": "red"}), {"event_id": "e1", "source": "app"}),
        (json.dumps({"event_id": "e1"}), {"event_id": "e1", "source": None}),
        (json.dumps([FULL]), {"event_id": None}),
        (json.dumps({**FULL, "event_data": {"a": [1, 2]}}), {"event_data": '{"a":[1,2]}'}),
    ],
)
def test_parse_events(spark, message, expected):
    value = None if message is None else bytearray(message.encode())
    messages = spark.createDataFrame([(value, "topic")], "value binary, topic string")
    events = bronze.parse_events(messages)
    assert validate_schema(events, BRONZE)
    (row,) = events.collect()
    assert {name: row[name] for name in expected} == expected
    assert row["ingestion_timestamp"] is not None


def test_parse_keeps_microseconds(spark):
    messages = spark.createDataFrame([(bytearray(json.dumps(FULL).encode()),)], "value binary")
    assert rows(bronze.parse_events(messages), "event_timestamp") == [(naive("2024-03-09 10:11:12.123456"),)]


def test_parse_json_column(spark):
    df = spark.createDataFrame([('{"a": 1}',)], "text string")
    assert rows(df.select(parse_json("text", StructType().add("a", IntegerType())).alias("s")).select("s.*")) == [(1,)]


def test_packed_rows_parse_back(frame):
    events = frame(event("ride_started", "2024-01-01 00:00:00.000001", ride="r", lat=0.1, long=-77.123456789012))
    messages = kafka.pack(events).select(F.col("value").cast("binary"))
    assert rows(bronze.parse_events(messages), *EVENT.names) == rows(events)


def test_pack_with_key(frame):
    events = frame(event("ride_started", "2024-01-01", ride="r", id="e"))
    (message,) = kafka.pack(events.select("event_id", "ride_id", "user_id"), key="ride_id").collect()
    assert message.key == "r"
    assert json.loads(message.value) == {"event_id": "e", "ride_id": "r"}


def test_kafka_options():
    assert kafka.read_options("host:1", "rides") == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "rides", "startingOffsets": "latest",
    }
    assert kafka.read_options("host:1", "rides", startingOffsets="earliest")["startingOffsets"] == "earliest"
    assert kafka.write_options("host:1", "out", "/c", includeHeaders="true") == {
        "kafka.bootstrap.servers": "host:1", "topic": "out", "checkpointLocation": "/c", "includeHeaders": "true",
    }


def test_rows_for_a_topic_are_packed_once(spark):
    rate = spark.readStream.format("rate").load()
    cases = [
        (rate, {}, ["value"], "string"),  # its own column "value" is a column like others
        (rate, {"key": "timestamp"}, ["key", "value"], "string"),
        (kafka.pack(rate, "timestamp"), {"packed": True}, ["key", "value"], "string"),
    ]
    for df, options, columns, kind in cases:
        sent = kafka.stream_writer(df, "host:1", "out", "/checkpoint", **options)._df
        assert sent.columns == columns and sent.schema["value"].dataType.simpleString() == kind


# -- schemas ------------------------------------------------------------------


def test_enforce_schema(spark):
    df = spark.createDataFrame([("x", 1, "7")], "extra string, b int, a string")
    schema = StructType().add("a", LongType()).add("c", DoubleType()).add("b", IntegerType())
    assert enforce_schema(df, schema).dtypes == [("a", "string"), ("c", "double"), ("b", "int")]
    assert rows(enforce_schema(df, schema)) == [("7", None, 1)]
    cast = enforce_schema(df, schema, cast=True)
    assert validate_schema(cast, schema)
    assert rows(cast) == [(7, None, 1)]


def test_cast_that_does_not_fit_is_null(spark):
    df = spark.createDataFrame([("many",)], "a string")
    assert rows(enforce_schema(df, StructType().add("a", LongType()), cast=True)) == [(None,)]


def test_validate_schema(spark):
    schema = StructType().add("a", LongType(), nullable=False).add("b", StringType())

    def valid(ddl):
        return validate_schema(spark.createDataFrame([], ddl), schema)

    assert valid("a bigint, b string")
    assert not valid("b string, a bigint")
    assert not valid("a bigint")
    assert not valid("a int, b string")
    assert not valid("a bigint, b string, c string")


NAMES = st.lists(st.sampled_from("abcdef"), unique=True, max_size=6)
TYPES = st.sampled_from(["string", "bigint", "double"])


@hypothesis.settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(present=NAMES, wanted=NAMES, data=st.data())
def test_enforced_is_always_valid(spark, present, wanted, data):
    types = {name: data.draw(TYPES) for name in "abcdef"}

    def schema_of(names):
        return StructType.fromDDL(", ".join(f"{name} {types[name]}" for name in names)) if names else StructType()

    df, schema = spark.createDataFrame([], schema_of(present)), schema_of(wanted)
    assert validate_schema(enforce_schema(df, schema), schema)


def test_merge_schemas():
    old = StructType().add("a", LongType()).add("b", StringType())
    new = StructType().add("c", DoubleType()).add("a", LongType())
    assert merge_schemas(old, new).names == ["a", "b", "c"]
    with pytest.raises(ValueError, match="column a is bigint"):
        merge_schemas(old, StructType().add("a", StringType()))


# -- time ---------------------------------------------------------------------


def test_time_periods(spark):
    df = spark.sql("SELECT TIMESTAMP '2023-01-01 17:30:00' AS t UNION ALL SELECT CAST(NULL AS TIMESTAMP)")
    periods = add_time_periods(df, "t")
    assert periods.columns == ["t", "year", "month", "day", "hour", "day_of_week", "week_of_year"]
    # A Sunday, in the last ISO week of the year before.
    assert rows(periods.drop("t")) == [(2023, 1, 1, 17, 1, 52), (None,) * 6]


def test_time_range_holds_both_ends(frame):
    times = ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-03 00:00:00.000001", None)
    events = frame(*[event("ride_started", time) for time in times])
    kept = filter_time_range(events, "event_timestamp", "2024-01-02", "2024-01-03")
    assert rows(kept, "event_timestamp") == [(naive("2024-01-02"),), (naive("2024-01-03"),)]


def test_time_range_of_no_time_is_an_error(frame):
    with pytest.raises(PySparkException):
        filter_time_range(frame(event("x", "2024-01-01")), "event_timestamp", "soon", "2024-01-01").collect()


def test_ingest_metadata(frame):
    events = frame(event("ride_started", "2024-03-09"))
    parts = ("year", "month", "day")
    assert rows(add_ingest_metadata(events, "event"), *parts) == [(2024, 3, 9)]
    assert rows(add_ingest_metadata(events, "ingest", as_of="2025-12-31"), *parts) == [(2025, 12, 31)]
    assert validate_schema(add_ingest_metadata(events, "ingest"), BRONZE)
    with pytest.raises(ValueError):
        add_ingest_metadata(events, "arrival")


# -- messages that are no events ---------------------------------------------


def messages_of(spark, *values):
    rows = [(k, None if v is None else bytearray(v if isinstance(v, bytes) else v.encode())) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "offset long, value binary")


def test_reasons(spark):
    good, unknown = json.dumps(FULL), json.dumps({**FULL, "colour": "red"})
    cases = {
        None: "empty", "": "not_json", "no json": "not_json", good[:-5]: "not_json", b"\xff\xfe": "not_text",
        "[1, 2]": "not_an_object", f"[{good}]": "not_an_object", "3": "not_an_object", '"text"': "not_an_object",
        "null": "not_an_object", json.dumps({**FULL, "latitude": "far"}): "bad_value",
        json.dumps({**FULL, "event_timestamp": "soon"}): "bad_value",
        good: None, f"  {good}": None, unknown: None, "{}": None, json.dumps({**FULL, "latitude": None}): None,
    }
    messages = messages_of(spark, *cases)
    found = dict(rows(bronze.checked(messages), "offset", "reason"))
    assert [found[k] for k in range(len(cases))] == list(cases.values())
    bad = bronze.quarantined(messages)
    assert bad.columns == ["offset", "value", "reason", "quarantined_at"]
    kept = {r.offset: r.value for r in bad.collect()}
    assert kept == {k: None if v is None else bytearray(v if isinstance(v, bytes) else v.encode()) for k, (v, reason) in enumerate(cases.items()) if reason}
    events = bronze.parse_whole(messages)
    assert validate_schema(events, BRONZE)
    assert events.count() + bad.count() == len(cases)
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_replay_after_a_repair_and_after_a_schema_fix(spark, lake):
    good = [json.dumps({**FULL, "event_id": f"e{k}"}) for k in range(4)]
    odd = json.dumps({**FULL, "event_id": "e9", "latitude": "far"})
    bronze.ingest_messages(spark, lake, messages_of(spark, good[0], f"[{good[1]}]", f"x{good[2]}", odd, None))
    assert rows(bronze.read_events(spark, lake), "event_id") == [("e0",)]
    unlisted = F.expr("CAST(trim(BOTH '[]' FROM CAST(value AS STRING)) AS BINARY)")
    for _ in range(2):  # again gives the same
        left = bronze.replay(spark, lake, lambda m: m.withColumn("value", unlisted))
        assert rows(left, "reason") == [("bad_value",), ("empty",), ("not_json",)]
        assert rows(bronze.read_events(spark, lake, "replayed"), "event_id") == [("e1",)]
    wider = StructType([StructField(f.name, StringType()) if f.name == "latitude" else f for f in EVENT.fields])
    left = bronze.replay(spark, lake, lambda m: m.withColumn("value", unlisted), schema=wider)
    assert rows(left, "reason") == [("empty",), ("not_json",)]
    assert rows(bronze.read_events(spark, lake, "replayed"), "event_id", "latitude") == [("e1", str(FULL["latitude"])), ("e9", "far")]


def test_quarantine_of_a_stream(spark, lake, tmp_path):
    messages_of(spark, json.dumps(FULL), "no json", None).write.parquet(str(tmp_path / "topic"))
    stream = spark.readStream.schema("offset long, value binary").parquet(str(tmp_path / "topic"))
    now = {"availableNow": True}
    assert await_all([start_bronze(bronze.parse_whole(stream), lake, trigger=now), start_quarantine(stream, lake, trigger=now)]) == []
    assert rows(bronze.read_events(spark, lake), "event_id") == [(FULL["event_id"],)]
    assert rows(lake.read(spark, "bronze", "quarantine"), "offset", "reason") == [(1, "not_json"), (2, "empty")]


# -- types -----------------------------------------------------------------------


@pytest.mark.parametrize(
    "old, new, both",
    [
        ("int", "long", "long"), ("long", "tinyint", "long"), ("float", "double", "double"), ("int", "float", "double"),
        ("smallint", "float", "float"), ("long", "double", None), ("decimal(10,2)", "decimal(5,4)", "decimal(12,4)"),
        ("decimal(38,0)", "decimal(38,10)", None), ("int", "decimal(4,2)", "decimal(12,2)"), ("date", "timestamp_ntz", "timestamp_ntz"),
        ("string", "int", None), ("array<int>", "array<long>", "array<long>"), ("map<string,int>", "map<string,long>", "map<string,long>"),
        ("struct<a:int,b:string>", "struct<b:string,a:long,c:date>", "struct<a:long,b:string,c:date>"),
        ("struct<a:int>", "struct<a:string>", None), ("void", "int", "int"), ("timestamp", "date", None),
    ],
)
def test_common_types(old, new, both):
    kinds = [StructType.fromDDL(f"x {kind}")["x"].dataType for kind in (old, new)]
    expected = both and StructType.fromDDL(f"x {both}")["x"].dataType
    assert common_type(*kinds) == expected


def test_old_and_new_rows_read_as_the_wider_type(spark, lake):
    lake.overwrite_merged(spark.sql("SELECT 1 AS a, named_struct('x', 1, 'y', 'q') AS s, array(1) AS l"), "silver", "t")
    new = spark.sql("SELECT 2L AS a, named_struct('y', 'r', 'x', 5L, 'z', 1.5F) AS s, array(7L) AS l")
    lake.overwrite_merged(new, "silver", "t")
    assert lake.read(spark, "silver", "t").schema.simpleString() == (
        "struct<a:bigint,s:struct<x:bigint,y:string,z:float>,l:array<bigint>>"
    )
    lake.overwrite_merged(spark.sql("SELECT 3 AS a, named_struct('x', 6, 'y', 's') AS s"), "silver", "t")
    assert [tuple(r) for r in lake.read(spark, "silver", "t").collect()] == [(3, (6, "s", None), None)]
    with pytest.raises(ValueError, match="column s"):
        lake.overwrite_merged(spark.sql("SELECT 1 AS a, 'text' AS s"), "silver", "t")


# -- files to bronze ----------------------------------------------------------


@pytest.fixture
def csv_file(tmp_path):
    def write(header, *lines):
        path = tmp_path / "events.csv"
        path.write_text("\n".join([",".join(header), *lines]) + "\n")
        return str(path)

    return write


def test_ingest_csv(spark, lake, csv_file):
    path = csv_file(EVENT.names, "e1,ride_started,2024-01-01T10:00:00Z,u,d,r,1.5,2.5,,app")
    bronze.ingest_csv(spark, lake, path, "events", as_of="2024-02-05")
    events = bronze.read_events(spark, lake)
    assert validate_schema(events, BRONZE)
    assert rows(events.drop("ingestion_timestamp")) == [
        ("e1", "ride_started", naive("2024-01-01 10:00:00"), "u", "d", "r", 1.5, 2.5, None, "app", 2024, 2, 5)
    ]


def test_csv_with_other_column_order_is_an_error(spark, csv_file):
    path = csv_file(["event_type", "event_id", *EVENT.names[2:]], "ride_started,e1,2024-01-01T10:00:00Z,,,,,,,app")
    with pytest.raises(Exception, match="header does not conform"):
        files.read_csv(spark, path, EVENT).collect()


def write_json(tmp_path, name, *events):
    folder = tmp_path / "history" / "events"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(e) + "\n" for e in events))
    return str(tmp_path / "history")


def test_ingest_json_glob_appends(spark, lake, tmp_path):
    write_json(tmp_path, "a.json", FULL)
    history = write_json(tmp_path, "b.json", {**FULL, "event_id": "e2"})
    for _ in range(2):
        bronze.ingest_json(spark, lake, f"{history}/events/*.json", "history")
    assert rows(bronze.read_events(spark, lake, "history"), "event_id") == [("e1",), ("e1",), ("e2",), ("e2",)]


def test_event_partitions_are_pruned(spark, lake, tmp_path):
    days = [{**FULL, "event_id": f"e{d}", "event_timestamp": f"2024-03-{d:02d}T12:00:00Z"} for d in range(1, 29)]
    history = write_json(tmp_path, "a.json", *days, {**FULL, "event_timestamp": None})
    bronze.ingest_json(spark, lake, f"{history}/events/*.json", "events", partition_by="event")
    span = {"start": "2024-03-10", "end": "2024-03-11 12:00:00"}
    pruned = bronze.read_events(spark, lake, **span)
    assert rows(pruned, "event_id") == [("e10",), ("e11",)]
    # One more day on each side.
    assert len(pruned.inputFiles()) == 28 + 1
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "make_date(year" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(event_timestamp" in plan
    assert rows(bronze.read_events(spark, lake, start="2024-03-28"), "event_id") == [("e28",)]
    with pytest.raises(ValueError, match="laid out otherwise"):
        bronze.ingest_json(spark, lake, f"{history}/events/*.json", "events", partition_by="ingest")
    # Replaced by a table of ingest dates, its partitions say nothing of the events.
    bronze.ingest_json(spark, lake, f"{history}/events/*.json", "events", as_of="2025-01-01", mode="overwrite")
    assert rows(bronze.read_events(spark, lake, **span), "event_id") == [("e10",), ("e11",)]


def test_a_missing_bound_cuts_nothing(spark, lake, tmp_path):
    times = ["9999-12-31T23:59:59.999999Z", "2024-01-01T00:00:00Z", "0001-01-01T00:00:00Z"]
    history = write_json(tmp_path, "a.json", *[{**FULL, "event_id": f"e{k}", "event_timestamp": t} for k, t in enumerate(times)])
    for layout in ("ingest", "event"):
        bronze.ingest_json(spark, lake, f"{history}/events/*.json", layout, partition_by=layout)

        def found(**bounds):
            return rows(bronze.read_events(spark, lake, layout, **bounds), "event_id")  # noqa: B023

        assert found(start="2020-01-01") == [("e0",), ("e1",)]
        assert found(end="2024-06-01") == [("e1",), ("e2",)]
        assert found() == [("e0",), ("e1",), ("e2",)]


def test_date_with_most_events_is_split(spark, lake, tmp_path):
    events = spark.range(20000).selectExpr(
        "uuid() AS event_id", "'ride_started' AS event_type", "uuid() AS ride_id",
        "IF(id % 100 = 0, TIMESTAMP '2024-03-08 12:00:00', TIMESTAMP '2024-03-09 12:00:00') AS event_timestamp",
    )
    events.repartition(8).write.json(str(tmp_path / "files"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
    try:
        bronze.ingest_json(spark, lake, str(tmp_path / "files"), "events", partition_by="event")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    month = tmp_path / "lake/bronze/events/year=2024/month=3"
    assert len(data_files(month / "day=9")) > 2
    assert len(data_files(month / "day=8")) == 1
    assert bronze.read_events(spark, lake).count() == 20000


# -- tables -------------------------------------------------------------------


def test_write_modes(spark, lake):
    df = spark.range(3)
    lake.write(df, "silver", "t")
    lake.write(df, "silver", "t")
    assert lake.read(spark, "silver", "t").count() == 6
    lake.write(df, "silver", "t", mode="overwrite")
    assert lake.read(spark, "silver", "t").count() == 3
    lake.write(df, "silver", "t", mode="ignore")
    with pytest.raises(ValueError, match="there is"):
        lake.write(df, "silver", "t", mode="error")
    with pytest.raises(ValueError, match="no layer"):
        lake.path("platinum", "t")


def test_records_per_file(spark, lake, tmp_path):
    lake.write(spark.range(100).coalesce(1), "silver", "t", max_records_per_file=30)
    assert len(files_of(spark, lake)) == 4


def test_overwrite_merged(spark, lake):
    lake.overwrite_merged(spark.sql("SELECT 1 AS a, 'x' AS b"), "silver", "t")
    lake.overwrite_merged(spark.sql("SELECT 2.5D AS c, 7 AS a"), "silver", "t")
    table = lake.read(spark, "silver", "t")
    assert table.columns == ["a", "b", "c"]
    assert rows(table) == [(7, None, 2.5)]
    with pytest.raises(ValueError):
        lake.overwrite_merged(spark.sql("SELECT 'text' AS a"), "silver", "t")
    assert rows(lake.read(spark, "silver", "t")) == [(7, None, 2.5)]
    # Wider, and what is narrower comes as what is there.
    lake.overwrite_merged(spark.sql("SELECT 8L AS a, 1 AS c"), "silver", "t")
    assert lake.read(spark, "silver", "t").schema.simpleString() == "struct<a:bigint,b:string,c:double>"
    lake.overwrite_merged(spark.sql("SELECT CAST(1 AS TINYINT) AS a"), "silver", "t")
    assert rows(lake.read(spark, "silver", "t")) == [(1, None, None)]


def test_overwrite_replaced(spark, lake):
    lake.overwrite_replaced(spark.sql("SELECT 1 AS a"), "gold", "t")
    lake.overwrite_replaced(spark.sql("SELECT 'x' AS a, 2 AS b"), "gold", "t")
    assert rows(lake.read(spark, "gold", "t")) == [("x", 2)]


def test_table_can_be_computed_from_itself(spark, lake):
    lake.write(spark.range(10), "silver", "t")
    for _ in range(2):
        lake.overwrite_replaced(lake.read(spark, "silver", "t").selectExpr("id + 1 AS id"), "silver", "t")
    assert rows(lake.read(spark, "silver", "t")) == sorted([(n,) for n in range(2, 12)], key=repr)


def test_failed_overwrite_leaves_the_table(spark, lake):
    lake.write(spark.range(3), "silver", "t")
    with pytest.raises(PySparkException):
        lake.overwrite_replaced(spark.range(3).selectExpr("1 DIV (id - 2) AS id"), "silver", "t")
    assert lake.read(spark, "silver", "t").count() == 3


def files_of(spark, lake, layer="silver", table="t"):
    return sorted(Path(lake.current(spark, layer, table).removeprefix("file:")).rglob("*.parquet"))


def test_readers_of_a_replaced_table_go_on(spark, lake):
    lake.write(spark.range(3), "silver", "t")
    first = lake.read(spark, "silver", "t")
    lake.overwrite_replaced(spark.range(10), "silver", "t")
    assert (first.count(), lake.read(spark, "silver", "t").count()) == (3, 10)


def test_replacement_cut_short_does_not_count(spark, lake, monkeypatch):
    lake.overwrite_replaced(spark.range(3), "silver", "t")
    with monkeypatch.context() as patch:
        # The process ended after the files were written.
        patch.setattr(Lake, "exists", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            lake.overwrite_replaced(spark.range(5), "silver", "t")
    assert lake.read(spark, "silver", "t").count() == 3
    lake.overwrite_replaced(spark.range(7), "silver", "t")
    assert lake.read(spark, "silver", "t").count() == 7


def test_old_directories_go_with_the_next_replacement(spark, lake, tmp_path):
    lake.write(spark.range(1), "silver", "t")
    for n in range(2, 6):
        lake.overwrite_replaced(spark.range(n), "silver", "t")
        assert lake.read(spark, "silver", "t").count() == n
    assert len(list((tmp_path / "lake/silver/t").iterdir())) == 2
    lake.write(spark.range(2), "silver", "t")
    assert lake.read(spark, "silver", "t").count() == 7


def test_buckets_are_replaced_one_by_one(spark, lake, tmp_path):
    def rows_of(*pairs):
        return lambda: spark.createDataFrame(list(pairs), f"id long, {BUCKET} int")

    table = ("silver", "t")
    lake.create_bucketed(spark, *table, spark.range(1).schema)
    assert lake.version(spark, *table) == -1 and rows(lake.read(spark, *table)) == []
    lake.replace_buckets(spark, *table, 0, rows_of((1, 1), (2, 2), (3, 3)))
    reader = lake.read(spark, *table)
    lake.replace_buckets(spark, *table, 4, rows_of((20, 2), (21, 2)))
    assert rows(lake.read(spark, *table)) == [(1,), (20,), (21,), (3,)]
    assert lake.version(spark, *table) == 4
    for version in (5, 6):
        lake.replace_buckets(spark, *table, version, rows_of((version, 2)))
    kept = sorted(str(p.relative_to(tmp_path / "lake/silver/t")) for p in (tmp_path / "lake/silver/t").glob(f"*/{BUCKET}=2"))
    assert kept == [f"{version:012d}/{BUCKET}=2" for version in (5, 6)]
    assert reader.columns == ["id"]


def test_replacement_of_buckets_is_finished_after_a_crash(spark, lake, monkeypatch):
    table = ("silver", "t")
    lake.create_bucketed(spark, *table, spark.range(1).schema)
    lake.replace_buckets(spark, *table, 0, lambda: spark.sql(f"SELECT id, CAST(id AS INT) AS {BUCKET} FROM range(4)"))
    sql, left = spark.sql, [3]

    def dies(session, text, *args):
        if text.startswith("ALTER TABLE"):
            left[0] -= 1
            if left[0] < 0:
                raise RuntimeError("lost")
        return sql(text, *args)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", dies)
        with pytest.raises(RuntimeError, match="lost"):
            lake.replace_buckets(spark, *table, 7, lambda: spark.createDataFrame([(10, 1), (20, 2)], f"id long, {BUCKET} int"))
    assert lake.version(spark, *table) == 0 and lake.unfinished(spark, *table) == 7
    lake.replace_buckets(spark, *table, 7)
    assert rows(lake.read(spark, *table)) == [(0,), (10,), (20,), (3,)]
    assert lake.unfinished(spark, *table) is None


def test_compact(spark, lake):
    lake.write(spark.range(1000).repartition(20), "silver", "t")
    assert len(files_of(spark, lake)) == 20
    size = sum(p.stat().st_size for p in files_of(spark, lake))
    lake.compact(spark, "silver", "t", file_bytes=size // 2)
    assert 1 < len(files_of(spark, lake)) <= 4
    lake.compact(spark, "silver", "t")
    assert len(files_of(spark, lake)) == 1
    assert lake.read(spark, "silver", "t").agg(F.count("id"), F.sum("id")).first() == (1000, 499500)


def test_compact_partitioned(spark, lake):
    df = spark.range(300).selectExpr("id", "id % 3 AS part", "IF(id % 2 = 0, NULL, 'x') AS sub").repartition(10)
    lake.write(df, "bronze", "t", partition_by=["part", "sub"])
    lake.write(spark.sql("SELECT 1000L AS id, 9L AS part, 'alone' AS sub"), "bronze", "t", partition_by=["part", "sub"])
    assert len(files_of(spark, lake, "bronze")) == 61
    alone = [file for file in files_of(spark, lake, "bronze") if "sub=alone" in str(file)]
    lake.compact(spark, "bronze", "t")
    assert len(files_of(spark, lake, "bronze")) == 7
    # Nothing to put together there.
    assert alone[0] in files_of(spark, lake, "bronze")
    assert lake.read(spark, "bronze", "t").where("part = 1").count() == 100
    before = files_of(spark, lake, "bronze")
    lake.compact(spark, "bronze", "t")
    assert files_of(spark, lake, "bronze") == before


def test_compact_keeps_ranges_apart(spark, lake):
    df = spark.range(20000).selectExpr("id", "hash(id) AS h")
    lake.overwrite_replaced(df.repartitionByRange(16, "h").sortWithinPartitions("h"), "gold", "t")
    size = sum(p.stat().st_size for p in files_of(spark, lake, "gold"))
    lake.compact(spark, "gold", "t", file_bytes=size // 3, cluster_by=["h"])
    found = files_of(spark, lake, "gold")
    assert 1 < len(found) < 16
    ranges = []
    for file in found:
        values = pq.ParquetFile(file).read(["h"]).column(0).to_pylist()
        assert values == sorted(values)
        ranges.append((values[0], values[-1]))
    ranges.sort()
    assert all(one[1] <= other[0] for one, other in zip(ranges, ranges[1:], strict=False))
    assert lake.read(spark, "gold", "t").count() == 20000


class Session:
    """A session with nothing but settings."""

    def __init__(self, **settings):
        self.conf = settings


def test_checkpoints_go_where_the_session_says():
    shared = Session(**{"spark.checkpoint.dir": "hdfs://name/shared/"})
    assert Lake.at(shared, "s3a://bucket/lake").checkpoint("bronze", "events") == (
        "hdfs://name/shared/bucket/lake/bronze/events"
    )
    assert Lake.at(Session(), "/lake").checkpoint("bronze", "events") == "/lake/checkpoints/bronze/events"


def test_shuffles_grow_with_the_input(spark, lake, tmp_path, monkeypatch):
    lake.write(spark.range(100000), "silver", "t")
    table = lake.read(spark, "silver", "t")
    size = settings.input_bytes(table.groupBy("id").count())
    assert size == sum(file.stat().st_size for file in files_of(spark, lake))
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

    def partitions(df):
        with settings.sized_for_writing(df):
            return spark.conf.get(initial, None)

    monkeypatch.setattr(settings, "INPUT_BYTES_PER_SHUFFLE_PARTITION", -(-size // 10))
    assert partitions(table) == "10"
    # A join reads both sides.
    assert partitions(table.join(table.alias("u"), "id")) == "20"
    monkeypatch.setattr(settings, "INPUT_BYTES_PER_SHUFFLE_PARTITION", size)
    assert partitions(table) is None
    assert settings.input_bytes(spark.sparkContext.parallelize([(1,)]).toDF("a int")) == 0
    assert spark.conf.get(initial, None) is None


# -- quality ------------------------------------------------------------------


def test_data_quality(frame):
    events = frame(
        event("ride_started", "2024-01-01", id="a"),
        event("ride_started", None, id="a"),
        event(None, None, id="a"),
        event("ride_started", "2024-01-01", id="b"),
    )
    events = events.unionByName(events.limit(1).withColumn("event_id", F.lit(None).cast("string")))
    checks = check_data_quality(events, "events", READ_EVENT, key="event_id")
    assert rows(checks) == [("events", "schema", None, 0, True), ("events", "unique", "event_id", 2, False)]
    checks = check_data_quality(events.drop("source"), "bronze", EVENT)
    assert rows(checks) == [
        ("bronze", "not_null", "event_id", 1, False),
        ("bronze", "not_null", "event_timestamp", 2, False),
        ("bronze", "not_null", "event_type", 1, False),
        ("bronze", "schema", None, 1, False),
    ]


def test_data_quality_of_nothing(frame, spark):
    checks = check_data_quality(spark.createDataFrame([], READ_EVENT), "events", EVENT, key="event_id")
    assert checks.where("NOT passed").count() == 0
    assert check_data_quality(spark.range(0), "events", EVENT).where("NOT passed").count() == 1


def test_counts(spark, lake):
    assert rows(row_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]
    df, seen = counted(spark.range(1000).repartition(7))
    lake.write(df, "gold", "t")
    assert seen.get == {"row_count": 1000}
