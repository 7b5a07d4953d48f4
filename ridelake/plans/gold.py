"""Silver tables into the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from ridelake.functions.time import AsOf
from ridelake.operators import analytics
from ridelake.operators.quality import counted
from ridelake.sources.lake import Lake
from ridelake.values import GOLD_ALIASES, GOLD_QUERY_COLUMNS

# Gold table -> its silver inputs, and whether it depends on the reporting date.
_INPUTS = {
    "daily_ride_metrics": (("rides",), False),
    "ride_geo_heatmap": (("rides",), False),
    "driver_performance": (("drivers", "rides"), True),
    "driver_geo_distribution": (("drivers",), False),
    "customer_segments": (("customers",), False),
    "customer_retention": (("customers", "rides"), True),
}
NAMES = tuple(_INPUTS)

# Silver tables that have to be there for a table to be built along with others.
_NEEDED = {
    "driver_geo_distribution": {"drivers", "rides"},
    "customer_segments": {"customers", "rides"},
}

_ROW_KEY = {"customer_segments": ("user_id",)}


def canonical(name: str) -> str:
    return GOLD_ALIASES.get(name, name)


def build(name: str, silver: dict[str, DataFrame], as_of: AsOf = None) -> DataFrame:
    """One gold table, under its name or an alias."""
    table = canonical(name)
    if table not in _INPUTS:
        raise ValueError(f"no gold table {name!r}; there are {', '.join(NAMES)}")
    inputs, dated = _INPUTS[table]
    options = {"as_of": as_of} if dated else {}
    return getattr(analytics, table)(*[silver[source] for source in inputs], **options)


def build_all(silver: dict[str, DataFrame], as_of: AsOf = None) -> dict[str, DataFrame]:
    """The gold tables for which the silver tables are there.

    Rides give two tables, drivers with rides two more, and customers with rides
    the last two.
    """
    return {
        name: build(name, silver, as_of)
        for name, (inputs, _) in _INPUTS.items()
        if _NEEDED.get(name, set(inputs)) <= silver.keys()
    }


def query_columns(name: str) -> tuple[str, ...]:
    """Columns that a gold table is usually filtered by."""
    return GOLD_QUERY_COLUMNS.get(canonical(name), ())


def cluster_columns(name: str) -> tuple[str, ...]:
    """Columns to sort a gold table's files by; none for a table without an entry.

    Completed to a key of the rows, so that a frequent value (most customers are in
    one segment) can be split over several ranges.
    """
    table = canonical(name)
    wanted = query_columns(name)
    return wanted + tuple(column for column in _ROW_KEY.get(table, ()) if column not in wanted)


def cluster(df: DataFrame, name: str) -> DataFrame:
    """Rows in files by range of the cluster columns: file statistics then let a
    query on them skip most files."""
    columns = cluster_columns(name)
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns) if columns else df


def write_gold(df: DataFrame, lake: Lake, name: str) -> Observation:
    """Replace a gold table and its schema, clustered; gives its ``row_count``."""
    rows, seen = counted(cluster(df, name))
    lake.overwrite_replaced(rows, "gold", name)
    return seen
