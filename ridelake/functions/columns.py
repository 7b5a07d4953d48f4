"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridelake.values import GRID_DECIMALS

def grid(coordinate: Column | str) -> Column:
    """The coordinate of the grid cell."""
    return F.round(coordinate, GRID_DECIMALS)


def share(part: Column | str, whole: Column | str) -> Column:
    """part / whole as a double, NULL when there is no whole."""
    return F.try_divide(part, whole)


def tier(value: Column, steps: Iterable[tuple[str, int]], otherwise: str, above: bool) -> Column:
    """The name of the first step that ``value`` is above (or below)."""
    column = F.lit(otherwise)
    for name, limit in reversed(tuple(steps)):
        column = F.when(value > limit if above else value < limit, F.lit(name)).otherwise(column)
    return column


def event_is(*event_types: str) -> Column:
    column = F.col("event_type")
    return column == event_types[0] if len(event_types) == 1 else column.isin(*event_types)


def sighting(*values: str) -> str:
    """SQL of values in event order: ``min`` of it is the earliest event's.

    Order is (event_timestamp, event_id), events without a time last; values
    follow, so even events equal in both are ordered the same way every time.
    """
    return f"struct(event_timestamp IS NULL AS timeless, event_timestamp AS at, event_id AS id, {', '.join(values)})"


def earlier(one: str, other: str) -> str:
    """SQL: whether a sighting comes before another, or with it."""
    order = [f"struct({x}.timeless, {x}.at, {x}.id)" for x in (one, other)]
    return f"{order[0]} <= {order[1]}"


def latest_sighting(*values: str) -> str:
    """As ``sighting`` for ``max``: NULL times come first in Spark's order anyway."""
    return f"struct(event_timestamp AS at, event_id AS id, {', '.join(values)})"
