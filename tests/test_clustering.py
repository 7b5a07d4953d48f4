"""Files of an interleaved table hold narrow ranges of each of its columns; rows stay as they are."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from ridelake.operators.clustering import interleaved, morton
from ridelake.plans import jobs
from ridelake.sources import storage


def files_holding(directory, column, value):
    """How many of the directory's files a filter on the value can't skip, and how many there are."""
    files = sorted(directory.glob("*.parquet"))
    hold = 0
    for file in files:
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.to_arrow_schema().get_field_index(column)
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        hold += any(s.min <= value <= s.max for s in stats)
    return hold, len(files)


def test_morton_numbers_are_the_bits_in_turns(spark):
    pairs = [(a, b) for a in range(8) for b in range(8)]
    df = spark.createDataFrame(pairs, "a int, b int")
    got = {(r.a, r.b): r.z for r in df.select("a", "b", morton([F.col("a"), F.col("b")], 3).alias("z")).collect()}
    assert got == {(a, b): int("".join(x + y for x, y in zip(f"{a:03b}", f"{b:03b}")), 2) for a, b in pairs}
    with pytest.raises(ValueError):
        morton([F.col("a")] * 11, 6)


def test_either_column_skips_files(spark, tmp_path):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(100)]
    table = [(day, f"driver_{i:06d}", i) for day in days for i in range(100)]
    random.Random(3).shuffle(table)
    df = spark.createDataFrame(table, "day date, driver string, n int").repartition(4)
    linear, both = tmp_path / "linear", tmp_path / "both"
    df.repartitionByRange(25, "day", "driver").write.parquet(str(linear))
    interleaved(df, ["day", "driver"], 25).write.parquet(str(both))
    assert rows(spark.read.parquet(str(both))) == rows(df)
    for column, value in (("day", days[37]), ("driver", "driver_000063")):
        hold, files = files_holding(both, column, value)
        assert files >= 20 and hold <= 10, (column, hold, files)
    assert files_holding(linear, "driver", "driver_000063")[0] >= 20


def test_any_type_nulls_and_equal_values(spark):
    when = dt.datetime(2024, 1, 1)
    table = [
        (None if i % 5 == 0 else when + dt.timedelta(hours=i), "é" * (i % 3), Decimal(i % 7), i % 2 == 0, float(i))
        for i in range(60)
    ] + [(None, None, None, None, None)] * 5 + [(None, "same", Decimal(1), True, float("nan"))] * 20
    df = spark.createDataFrame(table, "t timestamp_ntz, s string, d decimal(9,2), b boolean, f double")
    assert repr(rows(interleaved(df, df.columns, 4))) == repr(rows(df))  # NaN is no other NaN
    assert rows(interleaved(df.limit(0), ["s", "t"], 4)) == []
    assert rows(interleaved(df.select("s").filter("s IS NULL"), ["s"], 3)) == [(None,)] * 5
    assert interleaved(df, [], 3) is df
    with pytest.raises(ValueError, match="no quantiles"):
        interleaved(df.select(F.array("s").alias("x")), ["x"], 2)


def test_compaction_interleaves_a_gold_table(spark, lake):
    table = [(dt.date(2024, 1, 1 + i % 20), f"d{i // 20:03d}", i) for i in range(2000)]
    df = spark.createDataFrame(table, "ride_date date, driver_id string, total_rides int")
    lake.overwrite_replaced(df.repartition(9), "gold", "daily_ride_metrics")
    jobs.compact_gold(spark, lake, "daily_ride_metrics", interleave=True, file_bytes=1500)
    assert rows(lake.read(spark, "gold", "daily_ride_metrics")) == rows(df)
    files = storage.children(spark, lake.current(spark, "gold", "daily_ride_metrics"))
    assert sum(name.endswith(".parquet") for name in files) > 1
