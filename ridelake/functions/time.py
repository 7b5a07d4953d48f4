"""Time columns and time filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ridelake.schemas import DATE_PARTS

AsOf = dt.date | str | None

_DATES_OF = "dates_of"
_DATE_PART = dict(zip(DATE_PARTS, (F.year, F.month, F.dayofmonth)))
_TIME_PERIOD = {
    **_DATE_PART,
    "hour": F.hour,
    "day_of_week": F.dayofweek,
    "week_of_year": F.weekofyear,
}


def today(as_of: AsOf = None) -> Column:
    """The reporting date: ``as_of`` when given, else the current date."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def days_since(moment: Column | str, as_of: AsOf = None) -> Column:
    """Whole calendar days from ``moment`` to the reporting date."""
    return F.datediff(today(as_of), moment)


def add_time_periods(df: DataFrame, timestamp_col: str) -> DataFrame:
    """Add year, month, day, hour, day_of_week (Sunday is 1), week_of_year (ISO)."""
    return df.withColumns({name: part(timestamp_col) for name, part in _TIME_PERIOD.items()})


def filter_time_range(
    df: DataFrame, timestamp_col: str, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """Rows with start <= timestamp <= end; a date without a time is its midnight, and one bound may be missing."""
    column = F.col(timestamp_col)
    zoneless = isinstance(df.select(column).schema[0].dataType, TimestampNTZType)

    def bound(text: str) -> Column:
        moment = F.to_timestamp(F.lit(text))
        # Else Spark would cast the column, and the filter would not reach the file scan.
        return moment.cast(TimestampNTZType()) if zoneless else moment

    if start_date is not None:
        df = df.filter(column >= bound(start_date))
    return df if end_date is None else df.filter(column <= bound(end_date))


def filter_event_date_partitions(df: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    """Keep the year/month/day partitions that can hold events of the range.

    One day more on each side, so that a writer in another time zone does no harm.
    """
    date = F.make_date(*DATE_PARTS)
    if start_date is not None:
        df = df.filter(date >= F.date_sub(F.to_date(F.to_timestamp(F.lit(start_date))), 1))
    return df if end_date is None else df.filter(date <= F.date_add(F.to_date(F.to_timestamp(F.lit(end_date))), 1))


def add_ingest_metadata(df: DataFrame, partition_by: str, as_of: AsOf = None) -> DataFrame:
    """Add ingestion_timestamp and the year, month, day of the partition.

    ``partition_by="event"`` takes the date of the event, ``"ingest"`` the reporting date; which of them, the
    column's metadata say, which files keep (see ``dates_of``).
    """
    if partition_by not in ("event", "ingest"):
        raise ValueError(f"partition_by must be 'event' or 'ingest', not {partition_by!r}")
    moment = F.col("event_timestamp") if partition_by == "event" else today(as_of)
    parts = {name: part(moment) for name, part in _DATE_PART.items()}
    stamp = F.current_timestamp().alias("ingestion_timestamp", metadata={_DATES_OF: partition_by})
    return df.withColumns({"ingestion_timestamp": stamp, **parts})


def dates_of(df: DataFrame) -> str | None:
    """Whose date year, month and day are, "event" or "ingest"; None if the frame doesn't say."""
    if "ingestion_timestamp" not in df.columns:
        return None
    return df.schema["ingestion_timestamp"].metadata.get(_DATES_OF)
