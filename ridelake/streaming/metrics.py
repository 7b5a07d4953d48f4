"""What streaming queries report of themselves, in a table."""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ridelake.schemas import STREAM_METRICS
from ridelake.sources.lake import Lake


class StreamMetrics(StreamingQueryListener):
    """Keeps a row for each micro-batch of the session's queries, and one for each end, with its failure if it has one.

    Spark calls it in a thread of its own, which only takes notes; ``write`` appends them to the gold table
    ``stream_metrics``. Notes not yet written go with the driver. Used with ``with``, it listens inside, and writes at
    the end, once the ends of all queries that began inside have been noted (or ``patience`` seconds passed).
    """

    TABLE = "stream_metrics"

    def __init__(self, spark: SparkSession, lake: Lake, patience: float = 30):
        self._spark, self._lake, self._patience = spark, lake, patience
        self._notes: list[tuple] = []
        self._names: dict[str, str | None] = {}
        self._changed = threading.Condition()

    def __enter__(self) -> StreamMetrics:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        running = {str(query.runId) for query in self._spark.streams.active}
        until = time.monotonic() + self._patience
        with self._changed:
            while self._names.keys() - running and (left := until - time.monotonic()) > 0:
                self._changed.wait(left)
        self._spark.streams.removeListener(self)
        self.write()

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        of = event.progress
        seconds = of.batchDuration / 1000
        self._note([(of.name, str(of.runId), of.batchId, of.numInputRows, seconds, None, _now())])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        with self._changed:
            name = self._names.pop(run, None)
            self._notes.append((name, run, None, 0, None, event.exception, _now()))
            self._changed.notify_all()

    def _note(self, rows: Iterable[tuple]) -> None:
        with self._changed:
            self._notes += rows

    def write(self) -> int:
        """Append what was noted since the last time; gives how many rows. What can't be written stays noted."""
        with self._changed:
            rows, self._notes = self._notes, []
        if rows:
            try:
                df = self._spark.createDataFrame(rows, STREAM_METRICS).coalesce(1)
                self._lake.write(df, "gold", self.TABLE)
            except Exception:
                self._note(rows)
                raise
        return len(rows)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)
