"""Waiting for and stopping a set of streaming queries."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)


def await_all(
    queries: Iterable[StreamingQuery],
    poll_seconds: int = 5,
    between_polls: Callable[[], None] | None = None,
    stop_on_failure: bool = False,
) -> list[StreamingQuery]:
    """Wait until no query is running; gives those that failed, which are logged.

    The wait ends at once when any of the session's queries does. ``between_polls`` is called while all that are
    left run, about every ``poll_seconds``. If it raises, or with ``stop_on_failure`` if a query fails, the others
    are stopped.
    """
    queries = list(queries)
    if not queries:
        return []
    streams = SparkSession.active().streams
    failed: list[StreamingQuery] = []
    try:
        while running := [query for query in queries if query.isActive]:
            try:
                streams.awaitAnyTermination(poll_seconds)
            except StreamingQueryException:
                pass  # of which query, the next lines find
            streams.resetTerminated()
            new = [query for query in queries if query not in failed and query.exception() is not None]
            for query in new:
                log.warning("query %s (%s) failed: %s", query.name, query.id, query.exception())
            failed += new
            if failed and stop_on_failure:
                break
            if between_polls and all(query.isActive for query in running):
                between_polls()
    finally:
        stop_all(query for query in queries if query.isActive)
    return failed + [query for query in queries if query not in failed and query.exception() is not None]


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        query.stop()
