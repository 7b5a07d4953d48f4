"""Aggregates of sums and counts that are brought up to date from changed rows alone.

A group's sums are those of its rows; a row that changed is taken out with what it was and added as it is now. So the
cost is that of the changed rows and the groups they are in. Averages are kept as a sum and a count. A group without
rows left stays with a count of nothing, and ``finish`` leaves it out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.values import GRID_DECIMALS

SIGN = "_sign"


@dataclass(frozen=True)
class Sums:
    """``keys`` and ``measures`` are SQL of a row, measures whole numbers and never null; ``finished`` is SQL of a group."""

    name: str
    keys: Mapping[str, str]
    measures: Mapping[str, str]
    finished: Sequence[str]

    def of(self, rows: DataFrame, sign: str = "1") -> DataFrame:
        """Sums of each group of rows, each counted ``sign`` (SQL of the row) times."""
        keys = [f"{sql} AS {name}" for name, sql in self.keys.items()]
        measures = [f"CAST(({sql}) * ({sign}) AS BIGINT) AS {name}" for name, sql in self.measures.items()]
        return self._added(rows.selectExpr(*keys, *measures))

    def change(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """What rows that were ``old`` and are ``new`` change: groups whose sums stay the same are left out."""
        return self.moved(self._added(self.of(new).unionByName(self.of(old, "-1"))))

    def moved(self, change: DataFrame) -> DataFrame:
        return change.filter(" OR ".join(f"{name} <> 0" for name in self.measures))

    def apply(self, sums: DataFrame, change: DataFrame) -> DataFrame:
        return self._added(sums.unionByName(change))

    def finish(self, sums: DataFrame) -> DataFrame:
        return sums.filter("rides <> 0").selectExpr(*self.keys, *self.finished)

    def _added(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.sum(name).alias(name) for name in self.measures])


_MEASURES = {
    "rides": "1",
    "timed": "IF(duration_seconds IS NULL, 0, 1)",
    "duration": "coalesce(duration_seconds, 0)",
    "cancelled": "IF(ride_cancelled_timestamp IS NULL, 0, 1)",
}
_AVERAGE = "try_divide(duration, timed)"
_RATE = "try_divide(cancelled, rides) AS cancellation_rate"

DAILY = Sums(
    name="daily_ride_metrics",
    keys={"ride_date": "to_date(ride_started_timestamp)", "driver_id": "driver_id"},
    measures=_MEASURES,
    finished=(
        "rides AS total_rides",
        "IF(timed = 0, NULL, duration) AS total_duration",
        f"{_AVERAGE} AS avg_duration",
        "cancelled AS cancelled_rides",
        _RATE,
    ),
)

HEATMAP = Sums(
    name="ride_geo_heatmap",
    keys={
        "start_lat_rounded": f"round(ride_started_lat, {GRID_DECIMALS})",
        "start_long_rounded": f"round(ride_started_long, {GRID_DECIMALS})",
    },
    measures={name: sql for name, sql in _MEASURES.items() if name != "cancelled"},
    finished=("rides AS ride_count", f"{_AVERAGE} AS avg_duration"),
)

BY_DRIVER = Sums(
    name="driver_ride_metrics",
    keys={"driver_id": "driver_id"},
    measures=_MEASURES,
    finished=("rides AS total_rides", f"{_AVERAGE} AS avg_ride_duration", "cancelled AS cancelled_rides"),
)

SUMS = (DAILY, HEATMAP, BY_DRIVER)
