"""Events that were delivered more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROW = "_row"


def dedup_events(events: DataFrame) -> DataFrame:
    """One row for each event_id; events without an id all stay, as nothing tells them apart.

    Batch: the one that is least by time (those without one last), then by a hash of the row, so input order and
    partitioning make no difference. It travels as one struct through one aggregation, with partial minima before the
    shuffle, so an id with most of the rows is harmless. ``first_deliveries`` does it for streams.
    """
    order = F.struct(F.col("event_timestamp").isNull(), "event_timestamp", F.xxhash64(*events.columns))
    known = events.filter("event_id IS NOT NULL").groupBy("event_id")
    first = known.agg(F.min_by(F.struct(*events.columns), order).alias(_ROW)).select(f"{_ROW}.*")
    return first.unionByName(events.filter("event_id IS NULL"))


def first_deliveries(events: DataFrame, within: str | None = None) -> DataFrame:
    """The rows of a stream whose event_id hasn't come before; those without an id all stay.

    Without ``within`` the state holds every id there was, exactly. With it, e.g. "2 days", an id is forgotten when
    the event times have moved on that far, so that the state is bounded; what comes again later than that counts
    again, and events older than the watermark are dropped, as Spark does.
    """
    known = events.filter("event_id IS NOT NULL")
    if within is not None:
        first = known.withWatermark("event_timestamp", within).dropDuplicatesWithinWatermark(["event_id"])
    else:
        first = known.dropDuplicates(["event_id"])
    return first.unionByName(events.filter("event_id IS NULL"))
