"""The jobs: historical batch, stream, and refreshing what readers see."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ridelake.functions.time import AsOf
from ridelake.operators import analytics
from ridelake.operators.incremental import BY_DRIVER
from ridelake.plans import bronze, gold, silver
from ridelake.schemas import METRICS
from ridelake.sources.lake import Lake
from ridelake.streaming.bronze import start_bronze
from ridelake.streaming.gold import refresh_ride_gold
from ridelake.streaming.metrics import StreamMetrics
from ridelake.streaming.queries import await_all
from ridelake.streaming.silver import publish_silver, start_silver

METRICS_TABLE = "pipeline_metrics"

_HISTORICAL = "historical_"
# The historical table of this one goes by the shorter name.
_HISTORICAL_GOLD = {"daily_ride_metrics": "historical_ride_metrics"}


def log_metrics(spark: SparkSession, lake: Lake, row_counts: dict[str, int]) -> None:
    """Append (dataset, row_count, processed_at) rows to the metrics table."""
    now = dt.datetime.now(dt.timezone.utc)
    rows = [(name, count, now) for name, count in row_counts.items()]
    lake.write(spark.createDataFrame(rows, METRICS).coalesce(1), "gold", METRICS_TABLE)


def _write_gold_tables(spark: SparkSession, lake: Lake, tables: dict[str, DataFrame]) -> dict[str, int]:
    counts = {name: gold.write_gold(df, lake, name).get["row_count"] for name, df in tables.items()}
    if counts:
        log_metrics(spark, lake, counts)
    return counts


def run_batch(
    spark: SparkSession,
    lake: Lake,
    historical_path: str,
    gold_tables: Iterable[str] | None = None,
    as_of: AsOf = None,
    ingest_mode: str = "append",
) -> dict[str, int]:
    """``historical_path/events/*.json`` through all layers, as historical_* tables.

    Gives the row counts of the gold tables, by default all six. Gold is computed
    from the written silver tables, so each silver aggregation runs once.

    Running it again adds the files again; ``ingest_mode="overwrite"`` makes the run
    repeatable, for a scheduler that retries.
    """
    table, files = f"{_HISTORICAL}events", f"{historical_path}/events/*.json"
    bronze.ingest_json(spark, lake, files, table, as_of=as_of, mode=ingest_mode)
    events = bronze.read_events(spark, lake, table)
    for name in silver.ENTITIES:
        silver.write_silver(silver.build(name, events, as_of), lake, _HISTORICAL + name)

    tables = {name: lake.read(spark, "silver", _HISTORICAL + name) for name in silver.ENTITIES}
    wanted = [gold.canonical(name) for name in gold_tables or gold.NAMES]
    return _write_gold_tables(
        spark,
        lake,
        {_HISTORICAL_GOLD.get(name, _HISTORICAL + name): gold.build(name, tables, as_of) for name in wanted},
    )


def compact_gold(spark: SparkSession, lake: Lake, name: str, interleave: bool = False, **options) -> None:
    """Fewer and larger files of a gold table, in ranges of its cluster columns as before.

    With ``interleave`` a file holds a range of each of the columns the table is queried by, instead of the first
    one's only, so that a filter on any of them skips files.
    """
    if interleave:
        options["interleave"] = gold.query_columns(name)
    lake.compact(spark, "gold", name, cluster_by=gold.cluster_columns(name), **options)


def refresh_gold(spark: SparkSession, lake: Lake, as_of: AsOf = None) -> dict[str, int]:
    """Rewrite the gold tables from the silver tables there are."""
    names = [name for name in silver.ENTITIES if lake.exists(spark, "silver", name)]
    tables = {name: lake.read(spark, "silver", name) for name in names}
    return _write_gold_tables(spark, lake, gold.build_all(tables, as_of))


def refresh(spark: SparkSession, lake: Lake, as_of: AsOf = None) -> dict[str, int]:
    """Publish the streamed silver tables' changes, then bring gold up to date.

    The tables of rides' sums cost what changed (see ``streaming.gold``). The others have a row for each driver, cell
    or customer, and are rewritten: those that tell the days since something change with every date. Drivers'
    performance takes rides' sums by driver instead of the rides.
    """
    for entity in silver.ENTITIES.values():
        publish_silver(spark, lake, entity, as_of)
    refresh_ride_gold(spark, lake)
    counts = {name: lake.read(spark, "gold", name).count() for name in ("daily_ride_metrics", "ride_geo_heatmap")}
    tables = {name: lake.read(spark, "silver", name) for name in silver.ENTITIES}
    metrics = lake.read(spark, "gold", BY_DRIVER.name)
    rest = {
        "driver_performance": analytics.with_ride_metrics(tables["drivers"], metrics, as_of),
        **{name: gold.build(name, tables, as_of) for name in gold.NAMES if name not in (*counts, "driver_performance")},
    }
    counts |= {name: gold.write_gold(df, lake, name).get["row_count"] for name, df in rest.items()}
    log_metrics(spark, lake, counts)
    return counts


def start_streaming(
    spark: SparkSession,
    lake: Lake,
    messages: DataFrame,
    trigger: dict | None = None,
    bronze_writer: Callable[..., StreamingQuery] = start_bronze,
    **silver_options,
) -> list[StreamingQuery]:
    """Start the bronze stream (by ``start_bronze`` or ``start_sorted_bronze``) and the three silver streams behind it."""
    queries = [bronze_writer(bronze.parse_events(messages), lake, trigger=trigger)]
    for entity in silver.ENTITIES.values():
        queries.append(start_silver(spark, lake, entity, trigger=trigger, **silver_options))
    return queries


def run_streaming(
    spark: SparkSession,
    lake: Lake,
    messages: DataFrame,
    trigger: dict | None = None,
    refresh_seconds: float = 600,
    as_of: AsOf = None,
    bronze_writer: Callable[..., StreamingQuery] = start_bronze,
    metrics: StreamMetrics | None = None,
    **silver_options,
) -> list[StreamingQuery]:
    """Stream until the queries end, refreshing gold every so often and at the end.

    Without a ``trigger`` the run is bounded: what is there now goes through
    bronze, then silver, then gold. With ``metrics``, what the queries report is written to their table at each
    refresh and at the end. Gives the queries that failed; when one does, the others are
    stopped and nothing is published any more, so that gold never comes from silver tables of
    different progress. If a refresh raises, all queries are stopped before the error goes on.
    """
    if trigger is None:
        now = {"availableNow": True}
        failed = await_all([bronze_writer(bronze.parse_events(messages), lake, trigger=now)])
        if not failed:
            entities = silver.ENTITIES.values()
            failed = await_all(
                [start_silver(spark, lake, entity, trigger=now, **silver_options) for entity in entities]
            )
    else:
        queries = start_streaming(spark, lake, messages, trigger, bronze_writer, **silver_options)
        due = time.monotonic() + refresh_seconds

        def refresh_when_due() -> None:
            nonlocal due
            if time.monotonic() >= due:
                if metrics:
                    metrics.write()
                refresh(spark, lake, as_of)
                due = time.monotonic() + refresh_seconds

        failed = await_all(queries, between_polls=refresh_when_due, stop_on_failure=True)
    if metrics:
        metrics.write()
    if not failed:
        refresh(spark, lake, as_of)
    return failed
