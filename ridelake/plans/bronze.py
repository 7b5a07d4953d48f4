"""Raw events into the bronze layer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ridelake.functions.schema import parse_json
from ridelake.functions.time import (
    AsOf,
    add_ingest_metadata,
    dates_of,
    filter_event_date_partitions,
    filter_time_range,
)
from ridelake.schemas import DATE_PARTS, EVENT
from ridelake.sources import files
from ridelake.sources.lake import Lake

def parse_events(messages: DataFrame) -> DataFrame:
    """Messages with a binary JSON ``value`` as bronze events; batch or stream.

    A message that is not a JSON object stays as a row of NULLs, for the quality
    checks to count.
    """
    event = parse_json(F.col("value").cast("string"), EVENT)
    return add_ingest_metadata(messages.select(event.alias("event")).select("event.*"), partition_by="event")


# What keeps a message from being an event.
EMPTY, NOT_TEXT, NOT_JSON, NOT_AN_OBJECT, BAD_VALUE = "empty", "not_text", "not_json", "not_an_object", "bad_value"
_UNPARSED = "_unparsed"


def checked(messages: DataFrame, schema: StructType = EVENT) -> DataFrame:
    """Messages with the ``event`` in their ``value`` and the ``reason`` why they have none that is whole.

    Null reasons are events. The others are empty (NULL), not_text (bytes that aren't UTF-8), not_json,
    not_an_object (an array, a number, ...) or bad_value (a field that doesn't fit its type). Unknown and missing
    fields are no reason: null ids and types are for the quality checks. A second look at the text is taken only where
    the first parse failed, or it doesn't begin like an object. Batch or stream; one pass.
    """
    text = F.col("value").cast("string")
    wanted = StructType([*schema.fields, StructField(_UNPARSED, StringType())])
    parsed = F.from_json(text, wanted, {"columnNameOfCorruptRecord": _UNPARSED})
    rows = messages.withColumn("event", parsed)
    kind = F.schema_of_variant(F.try_parse_json(text))
    whole = F.col(f"event.{_UNPARSED}").isNull() & F.ltrim(text).startswith("{")
    reason = (
        F.when(F.col("value").isNull(), EMPTY)
        .when(~F.is_valid_utf8(text), NOT_TEXT)
        .when(whole, None)
        .when(kind.isNull(), NOT_JSON)
        .when(~kind.startswith("OBJECT"), NOT_AN_OBJECT)
        .when(F.col(f"event.{_UNPARSED}").isNotNull(), BAD_VALUE)
    )
    event = F.struct(*[F.col("event")[field.name].alias(field.name) for field in schema.fields])
    return rows.withColumns({"reason": reason, "event": event})


def parse_whole(messages: DataFrame, schema: StructType = EVENT) -> DataFrame:
    """The messages that are events, as bronze events; those that aren't are ``quarantined``."""
    events = checked(messages, schema).filter("reason IS NULL").select("event.*")
    return add_ingest_metadata(events, partition_by="event")


def quarantined(messages: DataFrame, schema: StructType = EVENT) -> DataFrame:
    """The messages that are no events, as they came, with the reason: all their columns (offset, topic, ...) stay."""
    bad = checked(messages, schema).filter("reason IS NOT NULL").drop("event")
    return bad.withColumn("quarantined_at", F.current_timestamp())


def ingest_messages(
    spark: SparkSession, lake: Lake, messages: DataFrame, table: str = "events", quarantine: str = "quarantine"
) -> None:
    """Append a batch of messages: events to a bronze table by their date, the others to another as they came."""
    _write_events(parse_whole(messages), lake, table, "event", "append")
    lake.write(quarantined(messages), "bronze", quarantine)


def replay(
    spark: SparkSession,
    lake: Lake,
    repair: Callable[[DataFrame], DataFrame],
    table: str = "replayed",
    quarantine: str = "quarantine",
    schema: StructType = EVENT,
) -> DataFrame:
    """Messages in quarantine read again, after ``repair`` (of their columns) or with another schema.

    Those that are events now are the whole content of a bronze table of their own, written anew each time, so a
    replay may be repeated or improved at will without counting anything twice. Gives those that still aren't.
    """
    messages = repair(lake.read(spark, "bronze", quarantine).drop("reason", "quarantined_at"))
    _write_events(parse_whole(messages, schema), lake, table, "event", "overwrite")
    return quarantined(messages, schema)


def ingest_csv(
    spark: SparkSession,
    lake: Lake,
    path: str,
    table: str,
    schema: StructType = EVENT,
    partition_by: str = "ingest",
    as_of: AsOf = None,
    mode: str = "append",
) -> None:
    """Append CSV files with a header to a bronze table, or write with another mode."""
    _ingest(files.read_csv(spark, path, schema), lake, table, partition_by, as_of, mode)


def ingest_json(
    spark: SparkSession,
    lake: Lake,
    path: str,
    table: str,
    schema: StructType = EVENT,
    partition_by: str = "ingest",
    as_of: AsOf = None,
    mode: str = "append",
) -> None:
    """Append JSON-lines files to a bronze table, or write with another mode."""
    _ingest(files.read_json(spark, path, schema), lake, table, partition_by, as_of, mode)


def _ingest(df: DataFrame, lake: Lake, table: str, partition_by: str, as_of: AsOf, mode: str) -> None:
    _write_events(add_ingest_metadata(df, partition_by, as_of), lake, table, partition_by, mode)


def _write_events(events: DataFrame, lake: Lake, table: str, partition_by: str, mode: str) -> None:
    if partition_by == "event":
        # Bring each date together, so that a task does not write one small file per
        # date. A date with most of the rows is split over many tasks.
        events = events.hint("rebalance", *DATE_PARTS)
    # Event types side by side in the files: the silver builds, which want one family
    # each, then skip the pages of the others. A sort within tasks, no shuffle.
    order = [*DATE_PARTS] + (["event_type"] if "event_type" in events.columns else [])
    if mode == "append" and lake.exists(events.sparkSession, "bronze", table):
        if (there := dates_of(lake.read(events.sparkSession, "bronze", table))) != partition_by:
            raise ValueError(f"bronze table {table} is laid out otherwise: its dates are of {there}")
    lake.write(events.sortWithinPartitions(*order), "bronze", table, mode, partition_by=DATE_PARTS)


def read_events(
    spark: SparkSession,
    lake: Lake,
    table: str = "events",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """A bronze table, optionally only start <= event_timestamp <= end; either bound may be missing.

    Where the table's partitions are event dates, as the stream and ``partition_by="event"`` write them, which its
    files say, other dates are not read.
    """
    events = lake.read(spark, "bronze", table)
    if dates_of(events) == "event" and not (start is None and end is None):
        events = filter_event_date_partitions(events, start, end)
    return filter_time_range(events, "event_timestamp", start, end)
