from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ridelake.schemas import EVENT
from ridelake.settings import tune
from ridelake.sources.lake import Lake

# Readers make every field nullable.
READ_EVENT = StructType([StructField(field.name, field.dataType) for field in EVENT])


_numbers = iter(range(10**9))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


def at(text: str) -> dt.datetime:
    """A UTC time, as Spark takes it whatever the machine's zone."""
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def event(kind, when=None, ride=None, driver=None, user=None, lat=None, long=None, id=None, data=None):
    """An event row; ids count up unless given."""
    when = at(when) if isinstance(when, str) else when
    id = f"e{next(_numbers):09d}" if id is None else id
    return (id, kind, when, user, driver, ride, lat, long, data, "test")


@pytest.fixture
def lake(tmp_path):
    root = tmp_path / "lake"
    name = f"lake_{next(_numbers)}"
    return Lake(*[str(root / part) for part in ("bronze", "silver", "gold", "checkpoints")], name=name)


@pytest.fixture
def frame(spark):
    def make(*events):
        return spark.createDataFrame(list(events), READ_EVENT)

    return make


def rows(df, *columns):
    """Rows as a sorted list of tuples; times without a zone."""
    df = df.select(*columns) if columns else df
    zoned = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if isinstance(f.dataType, TimestampType)}
    return sorted((tuple(row) for row in df.withColumns(zoned).collect()), key=repr)


def naive(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)
