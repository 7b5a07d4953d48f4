"""Session settings the library is meant to run with, and shuffle sizes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Dates and hours do not depend on where a job runs.
    "spark.sql.session.timeZone": "UTC",
    # Timestamps in Parquet with statistics, so that a time filter can skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Run-time plans: coalesced shuffle partitions, split skewed ones, measured broadcasts.
    "spark.sql.adaptive.enabled": "true",
}

# Files read per shuffle partition, all columns counted; what is shuffled is less.
INPUT_BYTES_PER_SHUFFLE_PARTITION = 1024**3

# Spark's size of data it knows nothing about is the greatest long.
_UNKNOWN_SIZE = 2**62

_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_PARALLELISM_FIRST = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session; sizes and parallelism stay the caller's."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def input_bytes(df: DataFrame) -> int:
    """Size of the files ``df`` reads, from the file listing its plan already has.

    Inputs of unknown size, such as frames made of RDDs, count nothing: whoever writes from those sets the number
    of shuffle partitions.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < _UNKNOWN_SIZE)


@contextmanager
def sized_for_writing(df: DataFrame) -> Iterator[None]:
    """Adaptive plans with shuffle partitions of a good size for ``df`` and its files.

    Spark merges shuffle partitions that turn out small but never divides those of
    an aggregation, so their number has to be large enough from the start: as the
    input needs, never less than ``spark.sql.shuffle.partitions``. Merging goes up
    to the advisory size, not just until every core has one, as each is a file.
    """
    conf = df.sparkSession.conf
    settings = {_PARALLELISM_FIRST: "false"}
    needed = -(-input_bytes(df) // INPUT_BYTES_PER_SHUFFLE_PARTITION)
    if needed > int(conf.get(_INITIAL, None) or conf.get("spark.sql.shuffle.partitions")):
        settings[_INITIAL] = str(needed)
    before = {name: conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)
