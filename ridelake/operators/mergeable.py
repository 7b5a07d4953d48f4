"""Per-key summaries that can be built from any slice of the events and merged.

A summary holds, per key, the columns an entity needs in a form where merging two
summaries gives the summary of both slices together, in any order. One definition
therefore serves the batch job (summarise everything once) and the stream
(summarise each micro-batch, merge later); see ``streaming.silver``.

Summarising is one ``groupBy`` on the key: one scan and one shuffle, and since the
partial aggregation runs before the shuffle, a key holding most of the rows sends
one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridelake.functions.columns import event_is


@dataclass(frozen=True)
class Part:
    """A summary column: an aggregate (min, max or sum) of an event-level value.

    The same aggregate merges it. ``event_type`` limits the events it is taken of.
    """

    aggregate: str
    value: str
    event_type: str | None = None

    def build(self, name: str) -> str:
        of_type = f" FILTER (WHERE event_type = '{self.event_type}')" if self.event_type else ""
        return f"{self.aggregate}({self.value}){of_type} AS {name}"

    def merge(self, name: str) -> str:
        return f"{self.aggregate}({name}) AS {name}"


@dataclass(frozen=True)
class Entity:
    """How one silver table comes out of the events.

    ``values`` are the event-level SQL expressions the summary's ``parts`` use;
    ``finish`` turns a summary into silver rows.
    """

    name: str
    key: str
    event_types: tuple[str, ...]
    schema: StructType
    values: Mapping[str, str]
    parts: Mapping[str, Part]
    finish: Callable[..., DataFrame]

    def events(self, events: DataFrame) -> DataFrame:
        """The events of this entity's family; the filter reaches the file scan."""
        return events.filter(event_is(*self.event_types))

    def summarise(self, events: DataFrame) -> DataFrame:
        values = [f"{value} AS {name}" for name, value in self.values.items()]
        rows = self.events(events).selectExpr(self.key, "event_type", "event_timestamp", *values)
        return self._aggregate(rows, Part.build)

    def merge(self, summaries: DataFrame) -> DataFrame:
        return self._aggregate(summaries, Part.merge)

    def build(self, events: DataFrame, **options) -> DataFrame:
        return self.finish(self.summarise(events), **options)

    def _aggregate(self, rows: DataFrame, column: Callable[[Part, str], str]) -> DataFrame:
        return rows.groupBy(self.key).agg(*[F.expr(column(part, name)) for name, part in self.parts.items()])
