"""The event stream into the bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ridelake.plans.bronze import quarantined
from ridelake.schemas import DATE_PARTS
from ridelake.settings import sized_for_writing
from ridelake.sources import storage
from ridelake.sources.lake import STREAM_BATCH, STREAM_FILE_LOG, Lake


def start_bronze(
    events: DataFrame,
    lake: Lake,
    table: str = "events",
    checkpoint_location: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append a stream of parsed events, partitioned by event date.

    ``trigger`` holds the arguments of ``DataStreamWriter.trigger``.
    """
    spark, path = events.sparkSession, lake.path("bronze", table)
    if lake.fmt != "delta" and lake.exists(spark, "bronze", table):
        if not storage.exists(spark, f"{path}/{STREAM_FILE_LOG}"):
            raise ValueError(f"{path} has files of another writer, which readers of a streamed table would not see")
    writer = (
        events.writeStream.format(lake.fmt)
        .outputMode("append")
        .partitionBy(*DATE_PARTS)
        .option("checkpointLocation", checkpoint_location or lake.checkpoint("bronze", table))
        .queryName(f"bronze_{table}")
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start(path)


def start_sorted_bronze(
    events: DataFrame,
    lake: Lake,
    table: str = "events",
    checkpoint_location: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append a stream of parsed events, each micro-batch a directory whose files are whole dates, sorted by event type.

    Rows of a date meet in few files, and a date with most of them is split. A micro-batch is written aside and then
    appears by one rename; run again after a crash it is written anew if it hadn't appeared, and left as it is if it
    had, so that readers, streams among them, see each event once. There is no list of all files that only grows.
    On a store whose rename isn't one step (plain object stores) use ``start_bronze`` or Delta instead.
    """
    spark, path = events.sparkSession, lake.path("bronze", table)
    if lake.fmt == "delta":
        raise ValueError("a Delta table appends a batch by its own transaction: use start_bronze")
    checkpoint = checkpoint_location or lake.checkpoint("bronze", table)
    if lake.exists(spark, "bronze", table):
        if not lake.has_batches(spark, "bronze", table):
            raise ValueError(f"{path} has files of another writer")
        if not storage.exists(spark, checkpoint):
            raise ValueError(f"the batches of {path} belong to a checkpoint that is not at {checkpoint}")
    writer = (
        events.writeStream.foreachBatch(lambda batch, batch_id: _add_batch(batch, batch_id, path))
        .option("checkpointLocation", checkpoint)
        .queryName(f"bronze_{table}")
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def _add_batch(events: DataFrame, batch_id: int, path: str) -> None:
    spark, there = events.sparkSession, f"{path}/{STREAM_BATCH}={batch_id}"
    if storage.exists(spark, there):
        return
    aside = f"{path}/_writing/{batch_id}"
    order = [*DATE_PARTS] + (["event_type"] if "event_type" in events.columns else [])
    rows = events.hint("rebalance", *DATE_PARTS).sortWithinPartitions(*order)
    with sized_for_writing(events):
        rows.write.mode("overwrite").partitionBy(*DATE_PARTS).parquet(aside)
    storage.move(spark, aside, there)


def start_quarantine(
    messages: DataFrame,
    lake: Lake,
    table: str = "quarantine",
    checkpoint_location: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append the stream's messages that are no events, as they came, to a table beside the events."""
    writer = (
        quarantined(messages)
        .writeStream.format(lake.fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint_location or lake.checkpoint("bronze", table))
        .queryName(f"bronze_{table}")
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start(lake.path("bronze", table))
