"""Where drivers were last, kept up to date from the bronze stream: all updates tied for a driver's latest time.

Of the rows there were and a micro-batch's, the last are the last of all (``last_updates``), so the table itself is the
state: a micro-batch writes the buckets of its drivers anew, with its number as their version. One that runs again
after a crash finds its version there, or finishes or replaces what was written of it. Updates may come as late as they like.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ridelake.operators.drivers import last_updates, location_updates
from ridelake.schemas import EVENT
from ridelake.sources import storage
from ridelake.sources.lake import BUCKET, Lake
from ridelake.streaming.silver import bucket_of, read_bronze_stream

TABLE = "latest_locations"
_PLACE = ("silver", TABLE)


def start_latest_locations(
    spark: SparkSession,
    lake: Lake,
    bronze_table: str = "events",
    checkpoint_location: str | None = None,
    trigger: dict | None = None,
    **source_options: str,
) -> StreamingQuery:
    """Keep ``silver.latest_locations`` (driver_id, event_timestamp, latitude, longitude) up to date with bronze.

    A driver's updates with the same, latest time are a row each, redelivered ones too; updates without a time count
    as before all others, and those without a driver are one driver's. Of a hot driver the rows are spread over tasks
    while the last are found and while the bucket is written.
    """
    checkpoint = checkpoint_location or lake.checkpoint(*_PLACE)
    if not storage.exists(spark, checkpoint) and lake.version(spark, *_PLACE) >= 0:
        raise ValueError(f"{lake.table(*_PLACE)} belongs to a checkpoint that is not at {checkpoint}")
    lake.create_bucketed(spark, *_PLACE, location_updates(spark.createDataFrame([], EVENT)).schema)
    writer = (
        location_updates(read_bronze_stream(spark, lake, bronze_table, **source_options))
        .writeStream.foreachBatch(lambda batch, batch_id: bring_up_to_date(lake, batch, batch_id))
        .option("checkpointLocation", checkpoint)
        .queryName(TABLE)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def bring_up_to_date(lake: Lake, updates: DataFrame, batch_id: int) -> None:
    """Add a micro-batch's updates to the table, unless it has them."""
    spark = updates.sparkSession
    done = lake.unfinished(spark, *_PLACE)
    if done is not None:
        lake.replace_buckets(spark, *_PLACE, done)
    if lake.version(spark, *_PLACE) < batch_id:
        last = last_updates(updates).persist()
        try:
            lake.replace_buckets(spark, *_PLACE, batch_id, lambda: _renewed(lake, last))
        finally:
            last.unpersist()


def _renewed(lake: Lake, last: DataFrame) -> DataFrame:
    bucket = bucket_of("driver_id")
    # At most as many numbers as there are buckets.
    touched = [row[BUCKET] for row in last.select(bucket).distinct().collect()]
    old = last.sparkSession.table(lake.table(*_PLACE)).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    return last_updates(old.unionByName(last)).withColumn(BUCKET, bucket)
