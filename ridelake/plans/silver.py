"""Bronze events into the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ridelake.functions.time import AsOf
from ridelake.operators.customers import CUSTOMER
from ridelake.operators.drivers import DRIVER
from ridelake.operators.mergeable import Entity
from ridelake.operators.rides import RIDE
from ridelake.sources.lake import Lake

ENTITIES = {entity.name: entity for entity in (RIDE, DRIVER, CUSTOMER)}


def entity_named(name: str) -> Entity:
    if name not in ENTITIES:
        raise ValueError(f"no entity {name!r}; there are {', '.join(ENTITIES)}")
    return ENTITIES[name]


def finish_options(entity: Entity, as_of: AsOf) -> dict:
    return {"as_of": as_of} if entity is RIDE else {}


def build(name: str, events: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The silver table ``rides``, ``drivers`` or ``customers`` from bronze events."""
    entity = entity_named(name)
    return entity.build(events, **finish_options(entity, as_of))


def rides(events: DataFrame, as_of: AsOf = None) -> DataFrame:
    return build("rides", events, as_of)


def drivers(events: DataFrame) -> DataFrame:
    return build("drivers", events)


def customers(events: DataFrame) -> DataFrame:
    return build("customers", events)


def write_silver(df: DataFrame, lake: Lake, table: str) -> None:
    """Replace a silver table's rows, keeping columns it already has.

    No compaction afterwards: the aggregation's output is already coalesced to
    files of a good size while it is written.
    """
    lake.overwrite_merged(df, "silver", table)
