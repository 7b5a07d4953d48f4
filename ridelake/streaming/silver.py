"""Silver tables kept up to date from the bronze stream.

Each entity's stream reads the bronze table (the topic is read once, not per entity) and aggregates it by key, in
Spark's state store: min, max and sum only, so events may come as late as they like. Every micro-batch writes the
summaries of the keys it changed to a directory of its own, in update mode; one that runs again after a crash replaces
it. ``publish_silver`` brings the table up to date with those: the keys' buckets are written anew, others not touched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructType

from ridelake.functions.time import AsOf
from ridelake.operators.dedup import first_deliveries
from ridelake.operators.incremental import SIGN
from ridelake.operators.mergeable import Entity
from ridelake.plans.silver import finish_options
from ridelake.schemas import BRONZE, EVENT
from ridelake.settings import sized_for_writing
from ridelake.sources import storage
from ridelake.sources.lake import BUCKET, Lake

#: Buckets of a silver table; a refresh reads and writes those that hold a changed key.
BUCKETS = 64
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_BATCH = "batch"


def read_bronze_stream(spark: SparkSession, lake: Lake, table: str, **options: str) -> DataFrame:
    path = lake.path("bronze", table)
    reader = spark.readStream.format(lake.fmt).options(**options)
    if lake.fmt != "delta":  # which brings its own schema
        storage.make_dirs(spark, path)
        reader = reader.schema(BRONZE)
    return reader.load(path)


def start_silver(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    bronze_table: str = "events",
    checkpoint_location: str | None = None,
    trigger: dict | None = None,
    deduplicate: bool = False,
    **source_options: str,
) -> StreamingQuery:
    """Keep the entity's summaries up to date with the bronze table.

    ``deduplicate`` counts events that come again, with an id seen before, only once; the state then holds all ids.
    ``source_options`` bound a micro-batch, e.g. ``maxBytesPerTrigger="1t"``. State is kept in RocksDB unless the
    session names another store.
    """
    changes = Changes(spark, lake, entity)
    checkpoint = checkpoint_location or lake.checkpoint("silver", entity.name)
    if not storage.exists(spark, checkpoint) and (changes.batches() or changes.published >= 0):
        raise ValueError(
            f"the summaries of {entity.name} belong to a checkpoint that is not at {checkpoint}: "
            "reading on from the start would count events twice"
        )
    if spark.conf.get(STATE_STORE, _ROCKSDB).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_STORE, _ROCKSDB)
    events = entity.events(read_bronze_stream(spark, lake, bronze_table, **source_options))
    if deduplicate:
        events = first_deliveries(events)
    writer = (
        entity.summarise(events)
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: Changes(batch.sparkSession, lake, entity).add(batch, batch_id))
        .option("checkpointLocation", checkpoint)
        .queryName(f"silver_{entity.name}")
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


@dataclass(frozen=True)
class Changes:
    """The summaries that micro-batches changed: of each key as they were after the batch, a directory for a batch."""

    spark: SparkSession
    lake: Lake
    entity: Entity

    @property
    def root(self) -> str:
        return f"{self.lake.silver}/_changes/{self.entity.name}"

    @property
    def published(self) -> int:
        """The last micro-batch that the table holds."""
        return self.lake.version(self.spark, "silver", self.entity.name)

    def add(self, summaries: DataFrame, batch_id: int) -> None:
        with sized_for_writing(summaries):
            summaries.hint("rebalance").write.mode("overwrite").parquet(f"{self.root}/{_BATCH}={batch_id}")

    def batches(self) -> list[int]:
        """Those whole."""
        names = storage.subdirectories(self.spark, self.root)
        whole = [name for name in names if storage.exists(self.spark, f"{self.root}/{name}/_SUCCESS")]
        return sorted(int(name.split("=", 1)[1]) for name in whole)

    def latest(self, first: int, last: int) -> DataFrame:
        """Of each key that was changed by the batches, the summary after the last that did."""
        key, parts = self.entity.key, list(self.entity.parts)
        schema = summary_schema(self.spark, self.entity).add(_BATCH, IntegerType())
        rows = self.spark.read.schema(schema).parquet(self.root).filter(F.col(_BATCH).between(first, last))
        last_of = F.max_by(F.struct(*parts), _BATCH).alias("last")
        return rows.groupBy(key).agg(last_of).select(key, "last.*")

    def forget(self, last: int) -> None:
        for batch in self.batches():
            if batch <= last:
                storage.delete(self.spark, f"{self.root}/{_BATCH}={batch}")


def summary_schema(spark: SparkSession, entity: Entity) -> StructType:
    """Of an entity's summaries as they are read back: any value may be null."""
    fields = entity.summarise(spark.createDataFrame([], EVENT)).schema.fields
    return StructType.fromDDL(", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in fields))


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def publish_silver(spark: SparkSession, lake: Lake, entity: Entity, as_of: AsOf = None) -> bool:
    """Bring the silver table up to date with the finished micro-batches; gives whether there were any.

    Rows that haven't changed stay as they are, with their processing date. What is read and written is the changes
    and the buckets of their keys. A publisher that died is finished first. One publisher at a time.
    """
    changes = Changes(spark, lake, entity)
    table = ("silver", entity.name)
    if not lake.exists(spark, *table):
        if storage.matching(spark, f"{lake.path(*table)}/*/_SUCCESS"):
            raise ValueError(f"the catalog has lost {lake.table(*table)}: rebuild_silver makes it from the stream's state")
        lake.create_bucketed(spark, *table, entity.schema)
    done = lake.unfinished(spark, *table)
    if done is not None:
        lake.replace_buckets(spark, *table, done)
    before = changes.published
    new = [batch for batch in changes.batches() if batch > before]
    if new:
        changed = Changed(spark, lake, entity.name)
        changed.write(_before_and_after(lake, entity, changes.latest(before + 1, new[-1]), as_of), before, new[-1])
        lake.replace_buckets(spark, *table, new[-1], lambda: _renewed(lake, entity, changed.rows(before, new[-1])))
        changes.forget(before)
    return bool(new) or done is not None


@dataclass(frozen=True)
class Changed:
    """Silver rows that a version changed: as they were (sign -1) and as they are (1), a directory for a version."""

    spark: SparkSession
    lake: Lake
    entity: str

    @property
    def root(self) -> str:
        return f"{self.lake.silver}/_changed/{self.entity}"

    def versions(self) -> list[int]:
        return sorted(int(name) for name in storage.subdirectories(self.spark, self.root) if name.isdigit())

    def write(self, rows: DataFrame, before: int, version: int) -> None:
        for stale in self.versions():  # of publishers that died before their version was whole
            if stale > before:
                storage.delete(self.spark, f"{self.root}/{stale:012d}")
        with sized_for_writing(rows):
            rows.write.mode("overwrite").parquet(f"{self.root}/{version:012d}")

    def rows(self, after: int, last: int) -> DataFrame:
        """What the versions after one and up to another changed, one after the other."""
        paths = [f"{self.root}/{v:012d}" for v in self.versions() if after < v <= last]
        return self.spark.read.parquet(*paths)

    def forget(self, last: int) -> None:
        for version in self.versions():
            if version <= last:
                storage.delete(self.spark, f"{self.root}/{version:012d}")


def _before_and_after(lake: Lake, entity: Entity, latest: DataFrame, as_of: AsOf) -> DataFrame:
    """The rows of the changed keys as they are in the table, and as they are to be."""
    key, new = entity.key, _bucketed(entity, latest, as_of)
    # At most BUCKETS numbers.
    touched = [row[BUCKET] for row in latest.select(bucket_of(key)).distinct().collect()]
    table = latest.sparkSession.table(lake.table("silver", entity.name)).filter(F.col(BUCKET).isin(touched))
    changed = latest.select(F.col(key).alias("_key"))
    old = table.join(changed, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    return new.withColumn(SIGN, F.lit(1)).unionByName(old.withColumn(SIGN, F.lit(-1)))


def _renewed(lake: Lake, entity: Entity, changed: DataFrame) -> DataFrame:
    """The buckets of the changed keys: their new rows, and the rows there of other keys."""
    key, new = entity.key, changed.filter(f"{SIGN} = 1").drop(SIGN)
    touched = [row[BUCKET] for row in new.select(BUCKET).distinct().collect()]
    table = changed.sparkSession.table(lake.table("silver", entity.name)).filter(F.col(BUCKET).isin(touched))
    keys = new.select(F.col(key).alias("_key"))
    return table.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti").unionByName(new)


def _bucketed(entity: Entity, summaries: DataFrame, as_of: AsOf) -> DataFrame:
    rows = entity.finish(summaries, **finish_options(entity, as_of))
    return rows.withColumn(BUCKET, bucket_of(entity.key))


def rebuild_silver(
    spark: SparkSession, lake: Lake, entity: Entity, checkpoint_location: str | None = None, as_of: AsOf = None
) -> None:
    """The silver table anew, whole, from the state of the entity's stream after its last finished micro-batch.

    For a table that was lost, with its session's catalog perhaps; the sums kept in gold have to be made anew too.
    The stream may go on meanwhile.
    """
    checkpoint = checkpoint_location or lake.checkpoint("silver", entity.name)
    saved = spark.read.format("state-metadata").load(checkpoint).filter("operatorName = 'stateStoreSave'").first()
    batch, options = saved["maxBatchId"], {"operatorId": saved["operatorId"], "batchId": saved["maxBatchId"]}
    state = spark.read.format("statestore").options(**options).load(checkpoint)
    # The state's fields are called after their aggregates, so many alike: taken whole, by place.
    fields = summary_schema(spark, entity).fields
    whole = state.select(F.col("key").cast(StructType(fields[:1])), F.col("value").cast(StructType(fields[1:])))
    summaries = whole.select("key.*", "value.*")
    table = ("silver", entity.name)
    lake.create_bucketed(spark, *table, entity.schema)
    storage.delete(spark, f"{lake.path(*table)}/{batch:012d}")
    rows = _bucketed(entity, summaries, as_of)
    Changed(spark, lake, entity.name).write(rows.withColumn(SIGN, F.lit(1)), -1, batch)
    lake.replace_buckets(spark, *table, batch, lambda: rows)
