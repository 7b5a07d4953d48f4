"""Gold tables of rides kept up to date from the silver rows that changed.

``publish_silver`` leaves, for each version of a silver table, its changed rows as they were and as they are. The sums
of the groups those rows are in are brought up to date, and only the buckets of those groups are written anew. The
gold table is a view on the sums: rates and averages are divided when it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators.incremental import SIGN, SUMS, Sums
from ridelake.sources.lake import BUCKET, Lake
from ridelake.streaming.silver import Changed, bucket_of

#: Beside the gold tables.
_PREFIX = "sums_of_"


def sums_table(sums: Sums) -> str:
    return f"{_PREFIX}{sums.name}"


def _bucket(sums: Sums) -> Column:
    """By the first key, a date in the daily table: a query on it reads one bucket, and a day's rides change one."""
    return bucket_of(next(iter(sums.keys)))


def refresh_sums(spark: SparkSession, lake: Lake, sums: Sums, entity: str = "rides") -> bool:
    """Bring the sums up to date with the silver table, and have the view on them; gives whether there were changes."""
    table, changed = ("gold", sums_table(sums)), Changed(spark, lake, entity)
    lake.create_bucketed(spark, *table, sums.of(spark.table(lake.table("silver", entity)).limit(0)).schema)
    done = lake.unfinished(spark, *table)
    if done is not None:
        lake.replace_buckets(spark, *table, done)
    before, now = lake.version(spark, *table), lake.version(spark, "silver", entity)
    if before < now:
        lake.replace_buckets(spark, *table, now, lambda: _renewed(lake, sums, changed.rows(before, now)))
    _have_view(spark, lake, sums)
    return before < now or done is not None


def _renewed(lake: Lake, sums: Sums, rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    change = sums.moved(sums.of(rows, SIGN)).withColumn(BUCKET, _bucket(sums))
    # At most as many numbers as there are buckets.
    touched = [row[BUCKET] for row in change.select(BUCKET).distinct().collect()]
    old = spark.table(lake.table("gold", sums_table(sums))).filter(F.col(BUCKET).isin(touched))
    return sums.apply(old.drop(BUCKET), change.drop(BUCKET)).withColumn(BUCKET, _bucket(sums))


def _have_view(spark: SparkSession, lake: Lake, sums: Sums) -> None:
    name = lake.table("gold", sums.name)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # as a batch job wrote it
    columns = ", ".join([*(f"`{key}`" for key in sums.keys), *sums.finished])
    source = f"SELECT {columns} FROM {lake.table('gold', sums_table(sums))} WHERE rides <> 0"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {source}")


def refresh_ride_gold(spark: SparkSession, lake: Lake) -> list[str]:
    """All tables of rides' sums; gives their names. What all of them have read of the changes is forgotten."""
    for sums in SUMS:
        refresh_sums(spark, lake, sums)
    Changed(spark, lake, "rides").forget(min(lake.version(spark, "gold", sums_table(sums)) for sums in SUMS))
    return [sums.name for sums in SUMS]
