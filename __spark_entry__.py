"""

Nearly every query reads the whole ``events`` table, as ride events (see
``ride_events``), some with ties, gaps and bad messages put in; two run general time helpers on other tables. ``AS_OF`` stands in for the current date.
"""

from __future__ import annotations

import importlib.util
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType, TimestampType

from ride_events import events_as_rides, read_event_log
from ridelake.functions.schema import enforce_schema
from ridelake.functions.time import add_ingest_metadata, add_time_periods, filter_time_range
from ridelake.operators import analytics
from ridelake.operators.dedup import dedup_events
from ridelake.operators.drivers import latest_location
from ridelake.operators.incremental import SUMS, Sums
from ridelake.operators.profile import merged, profile, report
from ridelake.operators.quality import check_data_quality
from ridelake.plans import bronze, gold, jobs, silver
from ridelake.schemas import EVENT
from ridelake.settings import input_bytes, tune
from ridelake.sources import kafka, storage
from ridelake.sources.lake import Lake
from ridelake.streaming.bronze import start_bronze, start_sorted_bronze
from ridelake.streaming.gold import refresh_sums
from ridelake.streaming.locations import TABLE as LOCATIONS
from ridelake.streaming.locations import start_latest_locations
from ridelake.streaming.metrics import StreamMetrics
from ridelake.streaming.queries import await_all
from ridelake.streaming.silver import publish_silver, start_silver

# The operators for training data are an addition: without their subpackage the other queries are all there are.
_WITH_LLM = all(map(importlib.util.find_spec, ("corpus_pipeline", "ridelake.llm"))) and (
    importlib.util.find_spec("ridelake.llm.queries") is not None
)
if _WITH_LLM:
    import corpus_pipeline
    from ridelake.llm import queries as llm

AS_OF = "2024-02-05"
RANGE = ("2024-01-10", "2024-01-20 12:00:00")
SHIPPED = ("1995-03-01", "1996-02-29")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_rides(read_event_log(tune(spark), f"{sf_dir}/events.parquet"))


def _zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as the tables have them, without a zone."""
    fields = [(f.name, isinstance(f.dataType, TimestampType)) for f in df.schema]
    return df.selectExpr(*[f"CAST({name} AS TIMESTAMP_NTZ) AS {name}" if zoned else name for name, zoned in fields])


def _query(transform: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _zoneless(transform(_events(spark, sf_dir)))


# -- bronze -----------------------------------------------------------------


def _messages(events: DataFrame) -> DataFrame:
    return kafka.pack(events).select(F.col("value").cast("binary").alias("value"))


def _parsed(events: DataFrame) -> DataFrame:
    return bronze.parse_events(_messages(events)).drop("ingestion_timestamp")


def _batch_metadata(events: DataFrame) -> DataFrame:
    stamped = add_ingest_metadata(events, "ingest", AS_OF)
    return stamped.select("event_id", "year", "month", "day")


def _time_periods(events: DataFrame) -> DataFrame:
    return add_time_periods(events.select("event_id", "event_timestamp"), "event_timestamp")


# A schema with a missing column, without most of the present ones, in another order.
_CONFORMED = (
    StructType()
    .add("ride_id", StringType())
    .add("vehicle_id", StringType())
    .add("fare_cents", LongType())
    .add("event_id", StringType())
    .add("event_timestamp", TimestampType())
)


def _time_periods_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tune(spark).read.parquet(f"{sf_dir}/orders.parquet")
    return add_time_periods(orders.select("o_orderkey", "o_orderdate"), "o_orderdate")


def _time_range_of_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = tune(spark).read.parquet(f"{sf_dir}/lineitem.parquet")
    shipped = filter_time_range(lineitem, "l_shipdate", *SHIPPED)
    return shipped.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")


# -- ties, gaps and bad input ---------------------------------------------------


def _with_gaps(events: DataFrame) -> DataFrame:
    """Times cut to the day, so that many are equal, and some values missing, by residues of the id."""
    number = "CAST(event_id AS BIGINT)"

    def missing(name: str, every: int) -> str:
        return f"IF({number} % {every} = 0, NULL, {name}) AS {name}"

    return events.selectExpr(
        "event_id",
        "event_type",
        f"IF({number} % 11 = 0, NULL, date_trunc('DAY', event_timestamp)) AS event_timestamp",
        *[missing(name, every) for name, every in GAPS.items()],
        "event_data",
        "source",
    )


GAPS = {"user_id": 13, "driver_id": 17, "ride_id": 19, "latitude": 3, "longitude": 5}


def _bad_messages(events: DataFrame) -> DataFrame:
    """One in seven isn't an event: no JSON, an array, or nothing."""
    packed = kafka.pack(events, "event_id").selectExpr("CAST(key AS BIGINT) % 21 AS n", "value")
    value = "CASE n WHEN 0 THEN 'no json' WHEN 7 THEN '[1, 2]' WHEN 14 THEN NULL ELSE value END"
    return bronze.parse_events(packed.selectExpr(f"CAST({value} AS BINARY) AS value")).drop("ingestion_timestamp")


# What was done to five in 21 messages: a word before it, put into a list, a letter in a number, a byte that isn't text, lost.
_DAMAGE = """
    CASE n
      WHEN 0 THEN CAST(concat('event: ', value) AS BINARY)
      WHEN 5 THEN CAST(concat('[', value, ']') AS BINARY)
      WHEN 10 THEN CAST(regexp_replace(value, '"latitude":([0-9.]+)', '"latitude":"N$1"') AS BINARY)
      WHEN 15 THEN concat(CAST(value AS BINARY), X'FF')
      WHEN 20 THEN NULL
      ELSE CAST(value AS BINARY)
    END AS value"""
_REPAIRED = """
    CASE reason_before
      WHEN 'not_json' THEN CAST(substr(CAST(value AS STRING), 8) AS BINARY)
      WHEN 'not_an_object' THEN CAST(trim(BOTH '[]' FROM CAST(value AS STRING)) AS BINARY)
      WHEN 'bad_value' THEN CAST(regexp_replace(CAST(value AS STRING), '"N([0-9.]+)"', '$1') AS BINARY)
      WHEN 'not_text' THEN substr(value, 1, length(value) - 1)
    END"""


def _damaged(events: DataFrame) -> DataFrame:
    packed = kafka.pack(events, "event_id").selectExpr("CAST(key AS BIGINT) AS offset", "CAST(key AS BIGINT) % 21 AS n", "value")
    return packed.selectExpr("offset", _DAMAGE)


def _quarantine_counts(events: DataFrame) -> DataFrame:
    """Messages that are no events, by reason, with the first offset of each."""
    bad = bronze.quarantined(_damaged(events))
    return bad.groupBy("reason").agg(F.count("*").alias("messages"), F.min("offset").alias("first_offset"))


def _replayed(events: DataFrame) -> DataFrame:
    """Events after the good messages were taken in and the bad ones, repaired, were read again."""
    spark = events.sparkSession
    _, lake = _scratch_lake(spark)
    bronze.ingest_messages(spark, lake, _damaged(events))

    def repaired(messages: DataFrame) -> DataFrame:
        reasons = bronze.checked(messages).withColumnRenamed("reason", "reason_before")
        return reasons.withColumn("value", F.expr(_REPAIRED)).drop("event", "reason_before")

    lost = bronze.replay(spark, lake, repaired)
    found = bronze.read_events(spark, lake).unionByName(bronze.read_events(spark, lake, "replayed"))
    empty = lost.selectExpr("CAST(offset AS STRING) AS event_id")
    return found.drop("ingestion_timestamp").unionByName(empty, allowMissingColumns=True)


def _redelivered(events: DataFrame) -> DataFrame:
    """Every third event comes twice, every 30th four times."""
    number = F.col("event_id").cast("bigint")
    again = events.filter(number % 3 == 0)
    rest = events.filter(number % 30 == 0)
    return events.unionByName(again).unionByName(rest).unionByName(rest)


def _violations(events: DataFrame) -> DataFrame:
    """Checks that all find something."""
    number = "CAST(event_id AS BIGINT)"
    spoilt = events.selectExpr(
        f"CASE WHEN {number} % 23 = 0 THEN NULL WHEN {number} % 29 = 0 THEN '1' ELSE event_id END AS event_id",
        f"IF({number} % 31 = 0, NULL, event_type) AS event_type",
        f"IF({number} % 37 = 0, NULL, event_timestamp) AS event_timestamp",
        f"IF({number} % 41 = 0, NULL, source) AS source",
    )
    return check_data_quality(spoilt, "events", EVENT, key="event_id")


PROFILED = ("event_id", "driver_id", "latitude")


def _profiled(events: DataFrame) -> DataFrame:
    """Columns' profiles by event type, merged; whether their estimates are as near to the exact counts as they say."""
    gaps = _with_gaps(events)
    whole = report(merged(profile(gaps, PROFILED, by=["event_type"])), shares=[0.5])
    exact = [F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("exact")) for c in PROFILED]
    counts = gaps.agg(F.array(*exact).alias("each")).select(F.inline("each"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.08 * F.col("exact")
    return whole.join(counts, "column_name").select("column_name", "row_count", "nulls", near.alias("near"))


# -- jobs, through files --------------------------------------------------------

_MICROSECONDS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_NOW = {"availableNow": True}


def _scratch_lake(spark: SparkSession) -> tuple[str, Lake]:
    """A new folder below the cluster's shared one, or else the warehouse, and a lake in it; gone with the session."""
    name = f"queries_{uuid.uuid4().hex}"
    if not (shared := spark.conf.get("spark.checkpoint.dir", None)):
        shared = spark.conf.get("spark.sql.warehouse.dir")
        storage.must_be_shared(spark, shared)
    root = storage.qualified(spark, f"{shared.rstrip('/')}/ridelake-queries/{name}")
    storage.delete_on_exit(spark, root)
    return root, Lake(f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/checkpoints", name=name)


def _ingested(fmt: str) -> Callable[[DataFrame], DataFrame]:
    """Events as files of a format, and those in bronze."""

    def transform(events: DataFrame) -> DataFrame:
        spark = events.sparkSession
        root, lake = _scratch_lake(spark)
        files = f"{root}/files"
        if fmt == "csv":
            events.write.options(**_MICROSECONDS, header=True).csv(files)
            bronze.ingest_csv(spark, lake, files, "events", partition_by="event")
        else:
            events.write.options(**_MICROSECONDS).json(files)
            bronze.ingest_json(spark, lake, files, "events", as_of=AS_OF)
        return bronze.read_events(spark, lake).drop("ingestion_timestamp")

    return transform


def _after_batch_job(layer: str, table: str, gold_tables: tuple[str, ...] | None) -> Callable[[DataFrame], DataFrame]:
    """A table the historical job writes, with those gold tables."""

    def transform(events: DataFrame) -> DataFrame:
        spark = events.sparkSession
        root, lake = _scratch_lake(spark)
        events.write.options(**_MICROSECONDS).json(f"{root}/history/events")
        jobs.run_batch(spark, lake, f"{root}/history", gold_tables=gold_tables, as_of=AS_OF)
        return lake.read(spark, layer, table)

    return transform


def _after_stream(name: str, write_bronze: Callable = start_bronze, **options) -> Callable[[DataFrame], DataFrame]:
    """A silver table after messages streamed into bronze, and bronze in slices into silver."""

    def transform(events: DataFrame) -> DataFrame:
        spark = events.sparkSession
        root, lake = _scratch_lake(spark)
        _messages(events).write.parquet(f"{root}/topic")
        messages = spark.readStream.schema("value BINARY").parquet(f"{root}/topic")
        failed = await_all([write_bronze(bronze.parse_events(messages), lake, trigger=_NOW)])

        slice_bytes = max(input_bytes(bronze.read_events(spark, lake)) // 3, 1)
        entity = silver.entity_named(name)
        failed += await_all([start_silver(spark, lake, entity, trigger=_NOW, maxBytesPerTrigger=str(slice_bytes), **options)])
        if failed:
            raise RuntimeError(f"failed: {[query.name for query in failed]}")
        publish_silver(spark, lake, entity, AS_OF)
        return lake.read(spark, "silver", name)

    return transform


def _tied_locations(events: DataFrame) -> DataFrame:
    """All last updates of drivers after the stream read bronze in slices."""
    spark = events.sparkSession
    root, lake = _scratch_lake(spark)
    _messages(events).write.parquet(f"{root}/topic")
    messages = spark.readStream.schema("value BINARY").parquet(f"{root}/topic")
    failed = await_all([start_bronze(bronze.parse_events(messages), lake, trigger=_NOW)])
    slice_bytes = max(input_bytes(bronze.read_events(spark, lake)) // 3, 1)
    failed += await_all([start_latest_locations(spark, lake, trigger=_NOW, maxBytesPerTrigger=str(slice_bytes))])
    if failed:
        raise RuntimeError(f"failed: {[query.name for query in failed]}")
    return lake.read(spark, "silver", LOCATIONS).select("driver_id", "latitude", "longitude")


def _streamed_gold(sums: Sums) -> Callable[[DataFrame], DataFrame]:
    """A table of rides' sums after two halves of the events: built from one, brought up to date with the other."""

    def transform(events: DataFrame) -> DataFrame:
        spark = events.sparkSession
        root, lake = _scratch_lake(spark)
        for half in (0, 1):
            part = events.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half)
            _messages(part).write.mode("append").parquet(f"{root}/topic")
            messages = spark.readStream.schema("value BINARY").parquet(f"{root}/topic")
            failed = await_all([start_bronze(bronze.parse_events(messages), lake, trigger=_NOW)])
            entity = silver.entity_named("rides")
            failed += await_all([start_silver(spark, lake, entity, trigger=_NOW)])
            if failed:
                raise RuntimeError(f"failed: {[query.name for query in failed]}")
            publish_silver(spark, lake, entity, AS_OF)
            refresh_sums(spark, lake, sums)
        return lake.read(spark, "gold", sums.name)

    return transform


def _after_streaming_job(events: DataFrame) -> DataFrame:
    """The row counts that the streaming job, from messages to gold, observes."""
    spark = events.sparkSession
    root, lake = _scratch_lake(spark)
    _messages(events).write.parquet(f"{root}/topic")
    messages = spark.readStream.schema("value BINARY").parquet(f"{root}/topic")
    if failed := jobs.run_streaming(spark, lake, messages, as_of=AS_OF):
        raise RuntimeError(f"failed: {[query.name for query in failed]}")
    return lake.read(spark, "gold", jobs.METRICS_TABLE).drop("processed_at")


def _stream_metrics(events: DataFrame) -> DataFrame:
    """What the bronze stream reports of itself, summed over its micro-batches."""
    spark = events.sparkSession
    root, lake = _scratch_lake(spark)
    _messages(events).write.parquet(f"{root}/topic")
    messages = spark.readStream.schema("value BINARY").option("maxFilesPerTrigger", 2).parquet(f"{root}/topic")
    with StreamMetrics(spark, lake):
        await_all([start_sorted_bronze(bronze.parse_events(messages), lake, trigger=_NOW)])
    seen = lake.read(spark, "gold", StreamMetrics.TABLE).groupBy("query")
    return seen.agg(F.sum("input_rows").alias("input_rows"), F.count("failure").alias("failures"))


def _silver_in(lake: Lake, events: DataFrame) -> None:
    for name, table in _silver(events).items():
        silver.write_silver(table, lake, name)


def _gold_counts(events: DataFrame) -> DataFrame:
    """Row counts of the gold tables, observed while they are written."""
    spark = events.sparkSession
    _, lake = _scratch_lake(spark)
    _silver_in(lake, events)
    jobs.refresh_gold(spark, lake, AS_OF)
    return lake.read(spark, "gold", jobs.METRICS_TABLE).drop("processed_at")


def _compacted_gold(events: DataFrame) -> DataFrame:
    """A clustered gold table after its many files were made few."""
    spark, name = events.sparkSession, "driver_performance"
    _, lake = _scratch_lake(spark)
    _silver_in(lake, events)
    tables = {entity: lake.read(spark, "silver", entity) for entity in silver.ENTITIES}
    built = gold.build(name, tables, AS_OF)
    columns = gold.cluster_columns(name)
    lake.overwrite_replaced(built.repartitionByRange(8, *columns).sortWithinPartitions(*columns), "gold", name)
    jobs.compact_gold(spark, lake, name)
    return lake.read(spark, "gold", name)


def _interleaved_gold(events: DataFrame) -> DataFrame:
    """A gold table after its files were made to hold ranges of both columns it is queried by."""
    spark, name = events.sparkSession, "daily_ride_metrics"
    _, lake = _scratch_lake(spark)
    _silver_in(lake, events)
    gold.write_gold(gold.build(name, {"rides": lake.read(spark, "silver", "rides")}), lake, name)
    size = input_bytes(lake.read(spark, "gold", name))
    jobs.compact_gold(spark, lake, name, interleave=True, file_bytes=max(size // 16, 1))
    return lake.read(spark, "gold", name)


def _schema_merged(events: DataFrame) -> DataFrame:
    """A silver table that had a column more before."""
    spark = events.sparkSession
    _, lake = _scratch_lake(spark)
    rides = silver.rides(events, AS_OF)
    silver.write_silver(rides.limit(0).withColumn("note", F.lit("old")), lake, "rides")
    silver.write_silver(rides, lake, "rides")
    return lake.read(spark, "silver", "rides")


JOBS = {
    "ingest_json": _ingested("json"),
    "ingest_csv": _ingested("csv"),
    "batch_job_rides": _after_batch_job("silver", "historical_rides", ("ride_geo_heatmap",)),
    "batch_job_ride_metrics": _after_batch_job("gold", "historical_ride_metrics", ("daily_ride_metrics",)),
    "batch_job_row_counts": lambda events: (
        _after_batch_job("gold", jobs.METRICS_TABLE, None)(events).drop("processed_at")
    ),
    "gold_row_counts": _gold_counts,
    "compacted_gold": _compacted_gold,
    "interleaved_gold": _interleaved_gold,
    "silver_schema_merged": _schema_merged,
    **{f"stream_{name}": _after_stream(name) for name in silver.ENTITIES},
    "stream_drivers_sorted_bronze": _after_stream("drivers", start_sorted_bronze),
    "stream_customers_redelivered": lambda events: _after_stream("customers", deduplicate=True)(_redelivered(events)),
    **{f"streamed_{sums.name}": _streamed_gold(sums) for sums in SUMS},
    "stream_latest_location_ties": lambda events: _tied_locations(_with_gaps(events)),
    "bronze_replayed": _replayed,
    "stream_job_row_counts": _after_streaming_job,
    "stream_metrics": _stream_metrics,
}


# -- gold ---------------------------------------------------------------------


def _silver(events: DataFrame) -> dict[str, DataFrame]:
    return {name: silver.build(name, events, AS_OF) for name in silver.ENTITIES}


TRAINING_DATA = {**llm.QUERIES, "pipeline": corpus_pipeline.run} if _WITH_LLM else {}


def _gold(name: str) -> Callable[[DataFrame], DataFrame]:
    return lambda events: gold.build(name, _silver(events), AS_OF)


def entry(spark: SparkSession) -> DataFrame:
    """Daily ride metrics of the smallest test tables."""
    return queries()["daily_ride_metrics"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    transforms = {
        "bronze_parse_events": _parsed,
        "bronze_batch_metadata": _batch_metadata,
        "time_periods": _time_periods,
        "filter_time_range": lambda events: filter_time_range(events, "event_timestamp", *RANGE),
        "enforce_schema": lambda events: enforce_schema(events, _CONFORMED),
        "silver_rides": lambda events: silver.rides(events, AS_OF),
        "silver_drivers": silver.drivers,
        "silver_customers": silver.customers,
        "silver_rides_with_gaps": lambda events: silver.rides(_with_gaps(events), AS_OF),
        "silver_drivers_with_gaps": lambda events: silver.drivers(_with_gaps(events)),
        "silver_customers_with_gaps": lambda events: silver.customers(_with_gaps(events)),
        "bronze_parse_bad_messages": _bad_messages,
        "bronze_quarantine": _quarantine_counts,
        "dedup_events": lambda events: dedup_events(_redelivered(events)),
        "data_quality_violations": _violations,
        "data_quality_profile": _profiled,
        "latest_location": latest_location,
        "latest_location_ties": lambda events: latest_location(_with_gaps(events), ties="all"),
        "driver_ride_metrics": lambda events: analytics.driver_ride_metrics(silver.rides(events)),
        "last_ride_per_customer": lambda events: analytics.last_ride_per_customer(silver.rides(events)),
        **{name: _gold(name) for name in gold.NAMES},
        "data_quality_events": lambda events: check_data_quality(events, "events", EVENT, key="event_id"),
        "data_quality_rides": lambda events: check_data_quality(events, "events", _CONFORMED, key="ride_id"),
        "kafka_pack": lambda events: kafka.pack(analytics.last_ride_per_customer(silver.rides(events)), "user_id"),
    }
    return {
        **{name: _query(transform) for name, transform in {**transforms, **JOBS}.items()},
        "time_periods_of_orders": _time_periods_of_orders,
        "filter_time_range_of_lineitem": _time_range_of_lineitem,
        **TRAINING_DATA,
    }


# -- the same in DuckDB -------------------------------------------------------

_EV = """
ev AS (
  SELECT * FROM (
    SELECT
      CASE WHEN events.user_id % 3 = 0 THEN events.user_id % 10 ELSE events.user_id END AS u,
      CAST(events.event_id AS VARCHAR) AS event_id,
      CASE WHEN events.event_type IN ('view', 'purchase', 'error')
          AND (u % 7 = 1 OR (u % 4 = 0 AND ts >= TIMESTAMP '2024-01-05')) THEN 'customer_ride_request'
      ELSE CASE event_type
        WHEN 'view' THEN 'ride_started'
        WHEN 'purchase' THEN 'ride_completed'
        WHEN 'error' THEN 'ride_cancelled'
        WHEN 'signup' THEN CASE event_id % 3
          WHEN 0 THEN 'customer_registered' WHEN 1 THEN 'driver_registered' ELSE 'driver_activated' END
        WHEN 'click' THEN CASE event_id % 2
          WHEN 0 THEN 'driver_location_update' ELSE 'customer_ride_request' END
      END END AS event_type,
      ts AS event_timestamp,
      CAST(u AS VARCHAR) AS user_id,
      CAST((event_id // 4) % 40 AS VARCHAR) AS driver_id,
      CAST(event_id // 4 AS VARCHAR) AS ride_id,
      CAST(12.902 + 0.01 * (events.user_id % 20) AS DOUBLE) AS latitude,
      CAST(77.502 + 0.01 * (event_id % 7) AS DOUBLE) AS longitude,
      props AS event_data,
      'app' AS source
    FROM events
  )
)"""

# The same as in ``_with_gaps``, under the same name as the events themselves.
_EV_WITH_GAPS = f"""{_EV.replace("ev AS (", "whole AS (", 1)},
ev AS (
  SELECT event_id, event_type, event_data, source,
    CASE WHEN n % 11 <> 0 THEN date_trunc('day', event_timestamp) END AS event_timestamp,
    {", ".join(f"CASE WHEN n % {every} <> 0 THEN {name} END AS {name}" for name, every in GAPS.items())}
  FROM (SELECT *, CAST(event_id AS BIGINT) AS n FROM whole)
)"""

_EV_SPOILT = f"""{_EV.replace("ev AS (", "whole AS (", 1)},
ev AS (
  SELECT CASE WHEN n % 23 = 0 THEN NULL WHEN n % 29 = 0 THEN '1' ELSE event_id END AS event_id,
    CASE WHEN n % 31 <> 0 THEN event_type END AS event_type,
    CASE WHEN n % 37 <> 0 THEN event_timestamp END AS event_timestamp,
    CASE WHEN n % 41 <> 0 THEN source END AS source
  FROM (SELECT *, CAST(event_id AS BIGINT) AS n FROM whole)
)"""

# Event order: events without a time last.
_ORDER = "(event_timestamp IS NULL, event_timestamp, event_id)"

_COLUMNS = (
    "event_id, event_type, event_timestamp, user_id, driver_id, ride_id, latitude, longitude, event_data, source"
)


def _first(value: str, condition: str) -> str:
    return f"arg_min({value}, {_ORDER}) FILTER (WHERE {condition} AND {value} IS NOT NULL)"


def _moments(*kinds: str) -> str:
    return ",\n".join(
        f"{_first('event_timestamp', f'event_type = {kind!r}')} AS {kind}_timestamp,\n"
        f"{_first('latitude', f'event_type = {kind!r}')} AS {kind}_lat,\n"
        f"{_first('longitude', f'event_type = {kind!r}')} AS {kind}_long"
        for kind in kinds
    )


_RIDES = f"""
rides AS (
  SELECT *,
    CASE WHEN ride_completed_timestamp IS NOT NULL THEN
      CAST(floor(epoch(ride_completed_timestamp)) AS BIGINT) - CAST(floor(epoch(ride_started_timestamp)) AS BIGINT)
    END AS duration_seconds,
    DATE '{AS_OF}' AS processing_date
  FROM (
    SELECT ride_id, {_first('driver_id', 'true')} AS driver_id, {_first('user_id', 'true')} AS user_id,
      {_moments('ride_started', 'ride_completed', 'ride_cancelled')}
    FROM ev WHERE event_type IN ('ride_started', 'ride_completed', 'ride_cancelled') GROUP BY ride_id
  )
)"""

_LATEST = """
latest AS (
  SELECT driver_id, latitude, longitude FROM (
    SELECT *, row_number() OVER (
      PARTITION BY driver_id ORDER BY event_timestamp DESC NULLS LAST, event_id DESC) AS r
    FROM ev WHERE event_type = 'driver_location_update'
  ) WHERE r = 1
)"""

_LATEST_TIES = _LATEST.replace("row_number()", "rank()").replace(", event_id DESC", "")

_DRIVERS = f"""{_LATEST},
drivers AS (
  SELECT * FROM (
    SELECT driver_id, {_moments('driver_registered', 'driver_activated')}
    FROM ev WHERE event_type IN ('driver_registered', 'driver_activated', 'driver_location_update')
    GROUP BY driver_id
  ) LEFT JOIN latest USING (driver_id)
)"""

_CUSTOMERS = f"""
customers AS (
  SELECT * FROM (
    SELECT user_id,
      min(event_timestamp) AS registration_date,
      arg_min_null(latitude, {_ORDER}) AS home_location_lat,
      arg_min_null(longitude, {_ORDER}) AS home_location_long
    FROM ev WHERE event_type = 'customer_registered' GROUP BY user_id
  ) LEFT JOIN (
    SELECT user_id, count(*) AS total_rides_requested
    FROM ev WHERE event_type = 'customer_ride_request' GROUP BY user_id
  ) USING (user_id)
)"""

_CANCELLED = "CAST(count(ride_cancelled_timestamp) AS BIGINT) AS cancelled_rides"

_GOLD = {
    "daily_ride_metrics": f"""
        SELECT *, cancelled_rides / total_rides AS cancellation_rate FROM (
          SELECT CAST(ride_started_timestamp AS DATE) AS ride_date, driver_id, count(*) AS total_rides,
            CAST(sum(duration_seconds) AS BIGINT) AS total_duration, avg(duration_seconds) AS avg_duration,
            {_CANCELLED}
          FROM rides GROUP BY ALL
        )""",
    "ride_geo_heatmap": """
        SELECT round(ride_started_lat, 2) AS start_lat_rounded, round(ride_started_long, 2) AS start_long_rounded,
          count(*) AS ride_count, avg(duration_seconds) AS avg_duration
        FROM rides GROUP BY ALL""",
    "driver_performance": f"""
        SELECT *, cancelled_rides / total_rides AS cancellation_rate,
          CASE WHEN DATE '{AS_OF}' - CAST(driver_activated_timestamp AS DATE) < 30
            THEN 'new' ELSE 'active' END AS active_status
        FROM drivers LEFT JOIN (
          SELECT driver_id, count(*) AS total_rides, avg(duration_seconds) AS avg_ride_duration, {_CANCELLED}
          FROM rides GROUP BY driver_id
        ) USING (driver_id)""",
    "driver_geo_distribution": """
        SELECT round(latitude, 2) AS lat_rounded, round(longitude, 2) AS long_rounded, count(*) AS driver_count
        FROM drivers GROUP BY ALL""",
    "customer_segments": """
        SELECT *, CASE WHEN total_rides_requested > 20 THEN 'frequent' WHEN total_rides_requested > 5 THEN 'regular'
          ELSE 'occasional' END AS customer_segment
        FROM customers""",
    "customer_retention": f"""
        SELECT *, CASE WHEN days_since_last_ride < 7 THEN 'active' WHEN days_since_last_ride < 30 THEN 'lapsing'
          ELSE 'churned' END AS retention_status
        FROM (
          SELECT *, CAST(date_diff('day', CAST(last_ride_date AS DATE), DATE '{AS_OF}') AS INTEGER)
            AS days_since_last_ride
          FROM customers LEFT JOIN (
            SELECT user_id, max(ride_started_timestamp) AS last_ride_date FROM rides GROUP BY user_id
          ) USING (user_id)
        )""",
}


_DRIVER_METRICS = f"""
    SELECT driver_id, count(*) AS total_rides, avg(duration_seconds) AS avg_ride_duration, {_CANCELLED}
    FROM rides GROUP BY driver_id"""


def _quality(required: tuple[str, ...], key: str, mismatch: int) -> str:
    checks = [
        f"SELECT 'not_null' AS check_name, '{name}' AS column_name, count(*) - count({name}) AS violations FROM ev"
        for name in required
    ]
    checks.append(f"SELECT 'unique', '{key}', count({key}) - count(DISTINCT {key}) FROM ev")
    checks.append(f"SELECT 'schema', CAST(NULL AS VARCHAR), CAST({mismatch} AS BIGINT)")
    union = " UNION ALL ".join(checks)
    return f"""
        SELECT 'events' AS table_name, check_name, column_name, CAST(violations AS BIGINT) AS violations,
          violations = 0 AS passed
        FROM ({union}) AS checks(check_name, column_name, violations)"""


def _date_parts(column: str) -> str:
    return ", ".join(f"CAST({part}({column}) AS INTEGER) AS {part}" for part in ("year", "month", "day"))


def _periods(column: str) -> str:
    # Sunday is 0 there.
    return f"""{_date_parts(column)}, CAST(hour({column}) AS INTEGER) AS hour,
      CAST(dayofweek({column}) + 1 AS INTEGER) AS day_of_week,
      CAST(weekofyear({column}) AS INTEGER) AS week_of_year"""


def _historical(name: str) -> str:
    return "historical_" + ("ride_metrics" if name == "daily_ride_metrics" else name)


def _row_counts(renamed: Callable[[str], str] = str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{renamed(name)}' AS dataset, count(*) AS row_count FROM ({sql})" for name, sql in _GOLD.items()
    )


def _with(*ctes: str, select: str, events: str = _EV) -> str:
    return f"WITH {', '.join((events, *ctes))}\n{select}"


def oracle_sql() -> dict[str, str]:
    everything = (_RIDES, _DRIVERS, _CUSTOMERS)
    silver_sql = {
        "rides": _with(_RIDES, select="SELECT * FROM rides"),
        "drivers": _with(_DRIVERS, select="SELECT * FROM drivers"),
        "customers": _with(_CUSTOMERS, select="SELECT * FROM customers"),
    }
    by_event = _with(select=f"SELECT {_COLUMNS}, {_date_parts('event_timestamp')} FROM ev")
    as_of = _date_parts(f"DATE '{AS_OF}'")
    return {
        "bronze_parse_events": by_event,
        "bronze_batch_metadata": _with(select=f"SELECT event_id, {as_of} FROM ev"),
        "ingest_json": _with(select=f"SELECT {_COLUMNS}, {as_of} FROM ev"),
        "ingest_csv": by_event,
        "batch_job_rides": silver_sql["rides"],
        "batch_job_ride_metrics": _with(_RIDES, select=_GOLD["daily_ride_metrics"]),
        "batch_job_row_counts": _with(*everything, select=_row_counts(_historical)),
        **{f"stream_{name}": sql for name, sql in silver_sql.items()},
        "stream_drivers_sorted_bronze": silver_sql["drivers"],
        "stream_customers_redelivered": silver_sql["customers"],
        "streamed_daily_ride_metrics": _with(_RIDES, select=_GOLD["daily_ride_metrics"]),
        "streamed_ride_geo_heatmap": _with(_RIDES, select=_GOLD["ride_geo_heatmap"]),
        "streamed_driver_ride_metrics": _with(_RIDES, select=_DRIVER_METRICS),
        "dedup_events": _with(select=f"SELECT {_COLUMNS} FROM ev"),
        "data_quality_profile": _with(
            select=" UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS nulls, true AS near FROM ev"
                for c in PROFILED
            ),
            events=_EV_WITH_GAPS,
        ),
        "stream_metrics": _with(
            select="SELECT 'bronze_events' AS query, count(*) AS input_rows, CAST(0 AS BIGINT) AS failures FROM ev"
        ),
        "bronze_quarantine": _with(
            select="""
            SELECT reason, count(*) AS messages, min(n) AS first_offset FROM (
              SELECT CAST(event_id AS BIGINT) AS n, CASE n % 21 WHEN 0 THEN 'not_json' WHEN 5 THEN 'not_an_object'
                WHEN 10 THEN 'bad_value' WHEN 15 THEN 'not_text' WHEN 20 THEN 'empty' END AS reason FROM ev
            ) WHERE reason IS NOT NULL GROUP BY reason"""
        ),
        "bronze_replayed": _with(
            select=f"""
            SELECT event_id, {", ".join(f"CASE WHEN CAST(event_id AS BIGINT) % 21 <> 20 THEN {c} END AS {c}" for c in _COLUMNS.split(", ")[1:])},
              {", ".join(f"CASE WHEN CAST(event_id AS BIGINT) % 21 <> 20 THEN CAST({part}(event_timestamp) AS INTEGER) END AS {part}" for part in ("year", "month", "day"))}
            FROM ev"""
        ),
        "time_periods": _with(select=f"SELECT event_id, event_timestamp, {_periods('event_timestamp')} FROM ev"),
        "time_periods_of_orders": f"SELECT o_orderkey, o_orderdate, {_periods('o_orderdate')} FROM orders",
        "filter_time_range_of_lineitem": f"""
            SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem
            WHERE l_shipdate BETWEEN TIMESTAMP '{SHIPPED[0]}' AND TIMESTAMP '{SHIPPED[1]}'""",
        "filter_time_range": _with(
            select=f"""
            SELECT {_COLUMNS} FROM ev
            WHERE event_timestamp BETWEEN TIMESTAMP '{RANGE[0]}' AND TIMESTAMP '{RANGE[1]}'"""
        ),
        "enforce_schema": _with(
            select="""
            SELECT ride_id, CAST(NULL AS VARCHAR) AS vehicle_id, CAST(NULL AS BIGINT) AS fare_cents,
              event_id, event_timestamp
            FROM ev"""
        ),
        **{f"silver_{name}": sql for name, sql in silver_sql.items()},
        **{f"silver_{name}_with_gaps": sql.replace(_EV, _EV_WITH_GAPS, 1) for name, sql in silver_sql.items()},
        "silver_schema_merged": _with(_RIDES, select="SELECT *, CAST(NULL AS VARCHAR) AS note FROM rides"),
        "bronze_parse_bad_messages": _with(
            select=f"""
            SELECT {", ".join(f"CASE WHEN CAST(event_id AS BIGINT) % 7 <> 0 THEN {c} END AS {c}" for c in _COLUMNS.split(", "))},
              {", ".join(f"CASE WHEN CAST(event_id AS BIGINT) % 7 <> 0 THEN CAST({part}(event_timestamp) AS INTEGER) END AS {part}" for part in ("year", "month", "day"))}
            FROM ev"""
        ),
        "data_quality_violations": _with(
            select=_quality(("event_id", "event_type", "event_timestamp", "source"), "event_id", 1), events=_EV_SPOILT
        ),
        "latest_location": _with(_LATEST, select="SELECT * FROM latest"),
        "stream_latest_location_ties": _with(_LATEST_TIES, select="SELECT * FROM latest", events=_EV_WITH_GAPS),
        "latest_location_ties": _with(_LATEST_TIES, select="SELECT * FROM latest", events=_EV_WITH_GAPS),
        "driver_ride_metrics": _with(_RIDES, select=_DRIVER_METRICS),
        "last_ride_per_customer": _with(
            _RIDES, select="SELECT user_id, max(ride_started_timestamp) AS last_ride_date FROM rides GROUP BY user_id"
        ),
        **{name: _with(*everything, select=sql) for name, sql in _GOLD.items()},
        "data_quality_events": _with(
            select=_quality(("event_id", "event_type", "event_timestamp", "source"), "event_id", 0)
        ),
        "data_quality_rides": _with(select=_quality((), "ride_id", 1)),
        "kafka_pack": _with(
            _RIDES,
            select="""
            SELECT user_id AS key, '{"user_id":"' || user_id || '"' ||
              coalesce(',"last_ride_date":"' || strftime(last_ride_date, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"', '') || '}'
              AS value
            FROM (SELECT user_id, max(ride_started_timestamp) AS last_ride_date FROM rides GROUP BY user_id)""",
        ),
        "gold_row_counts": _with(*everything, select=_row_counts()),
        "stream_job_row_counts": _with(*everything, select=_row_counts()),
        "compacted_gold": _with(*everything, select=_GOLD["driver_performance"]),
        "interleaved_gold": _with(_RIDES, select=_GOLD["daily_ride_metrics"]),
        **(llm.ORACLES if _WITH_LLM else {}),
    }
