"""Topics as streams. The Kafka connector has to be on the session's class path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def read_options(bootstrap_servers: str, topic: str, **more: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        **more,
    }


def write_options(bootstrap_servers: str, topic: str, checkpoint_location: str, **more: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "topic": topic,
        "checkpointLocation": checkpoint_location,
        **more,
    }


def read_stream(spark: SparkSession, bootstrap_servers: str, topic: str, **more: str) -> DataFrame:
    """The topic's messages, from the latest offsets unless an option says otherwise."""
    options = read_options(bootstrap_servers, topic, **more)
    return spark.readStream.format("kafka").options(**options).load()


# The default would cut timestamps to milliseconds.
_JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def pack(df: DataFrame, key: str | Column | None = None) -> DataFrame:
    """Rows as messages: ``value`` is the row as JSON, ``key`` decides the partition."""
    value = F.to_json(F.struct("*"), _JSON_OPTIONS).alias("value")
    if key is None:
        return df.select(value)
    column = F.col(key) if isinstance(key, str) else key
    return df.select(column.cast("string").alias("key"), value)


def stream_writer(
    df: DataFrame,
    bootstrap_servers: str,
    topic: str,
    checkpoint_location: str,
    key: str | Column | None = None,
    packed: bool = False,
    **more: str,
) -> DataStreamWriter:
    """Rows are packed, with ``key`` deciding the partition; ``packed`` says that they are messages already."""
    messages = df if packed else pack(df, key)
    options = write_options(bootstrap_servers, topic, checkpoint_location, **more)
    return messages.writeStream.format("kafka").options(**options)


def write_stream(
    df: DataFrame,
    bootstrap_servers: str,
    topic: str,
    checkpoint_location: str,
    key: str | Column | None = None,
    packed: bool = False,
    **more: str,
) -> StreamingQuery:
    """Send a stream's rows to a topic."""
    return stream_writer(df, bootstrap_servers, topic, checkpoint_location, key, packed, **more).start()
