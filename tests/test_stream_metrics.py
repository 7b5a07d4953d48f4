"""Streaming queries leave rows in the metrics table, also when they fail."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridelake.plans import bronze
from ridelake.streaming.bronze import start_sorted_bronze
from ridelake.streaming.metrics import StreamMetrics
from ridelake.streaming.queries import await_all

NOW = {"availableNow": True}


def test_batches_and_failures_are_in_the_table(spark, lake, tmp_path):
    topic = str(tmp_path / "topic")
    spark.range(50).select(F.lit(b"{}").alias("value")).repartition(3).write.parquet(topic)
    messages = spark.readStream.schema("value binary").option("maxFilesPerTrigger", 1).parquet(topic)

    def fails(batch, batch_id):
        raise RuntimeError("no room")

    with StreamMetrics(spark, lake) as metrics:
        assert await_all([start_sorted_bronze(bronze.parse_events(messages), lake, trigger=NOW)]) == []
        bad = messages.writeStream.foreachBatch(fails).queryName("bad").trigger(**NOW)
        assert len(await_all([bad.option("checkpointLocation", str(tmp_path / "bad")).start()])) == 1
    table = lake.read(spark, "gold", StreamMetrics.TABLE)
    good = table.filter("query = 'bronze_events'")
    assert good.filter("batch_id IS NOT NULL").agg(F.sum("input_rows"), F.count_distinct("batch_id")).first()[:] == (50, 3)
    assert good.filter("failure IS NOT NULL").count() == 0
    (row,) = table.filter("query = 'bad' AND failure IS NOT NULL").collect()
    assert "no room" in row.failure
    assert metrics.write() == 0


def test_what_cannot_be_written_stays_noted(spark, lake, monkeypatch):
    metrics = StreamMetrics(spark, lake)
    metrics._note([("q", "r", 0, 1, 0.5, None, dt.datetime(2024, 1, 1))])
    with monkeypatch.context() as patch:
        patch.setattr(type(lake), "write", lambda *_: (_ for _ in ()).throw(OSError("full")))
        with pytest.raises(OSError):
            metrics.write()
    assert metrics.write() == 1
