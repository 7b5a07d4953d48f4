"""The layered tables.

Bronze tables are directories that files are added to, by jobs or by a stream. Silver and gold tables are external
tables of the session's catalog, in one database for each layer. They are replaced by writing a new directory and
pointing the table at it, one step of the catalog: a job that dies before leaves the old table in place. The directory
replaced stays until the next replacement, for readers at work. A table of changing rows is partitioned by ``_bucket``,
and only the buckets that changed are written anew and pointed at. With ``fmt="delta"`` the format's own transactions
do all this, in the table's directory.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ridelake.functions.schema import enforce_schema, merge_schemas
from ridelake.operators.clustering import interleaved
from ridelake.settings import sized_for_writing
from ridelake.sources import storage

# Where Spark's streaming file sink keeps the list of files that count.
STREAM_FILE_LOG = "_spark_metadata"

DEFAULT_FILE_BYTES = 256 * 1024 * 1024

# The partition column of tables that are replaced bucket by bucket; readers don't see it.
BUCKET = "_bucket"

# The partition column of bronze tables that a stream writes micro-batch by micro-batch; readers don't see it.
STREAM_BATCH = "_stream_batch"

# What a table's properties say: the directory before the current one, and the version its buckets are up to.
_BEFORE, _VERSION = "ridelake.before", "ridelake.version"


@dataclass(frozen=True)
class Lake:
    """Where the layers are, in which file format, and the name its databases begin with.

    The databases are ``<name>_silver`` and ``<name>_gold``; whether they outlive the session is its catalog's matter.
    """

    bronze: str
    silver: str
    gold: str
    checkpoints: str
    fmt: str = "parquet"
    name: str = "lake"

    @classmethod
    def at(cls, spark: SparkSession, root: str, fmt: str = "parquet", name: str = "lake") -> Lake:
        """All layers below one root.

        Checkpoints go to this lake's part of the session's ``spark.checkpoint.dir``,
        and only without such a setting below the root.
        """
        shared = spark.conf.get("spark.checkpoint.dir", None)
        own = root.split(":", 1)[-1].strip("/")
        checkpoints = f"{shared.rstrip('/')}/{own}" if shared else f"{root}/checkpoints"
        return cls(f"{root}/bronze", f"{root}/silver", f"{root}/gold", checkpoints, fmt, name)

    def root(self, layer: str) -> str:
        roots = {"bronze": self.bronze, "silver": self.silver, "gold": self.gold}
        if layer not in roots:
            raise ValueError(f"no layer {layer!r}; there are {', '.join(roots)}")
        return roots[layer]

    def path(self, layer: str, table: str) -> str:
        return f"{self.root(layer)}/{table}"

    def checkpoint(self, layer: str, table: str) -> str:
        return f"{self.checkpoints}/{layer}/{table}"

    def table(self, layer: str, table: str) -> str:
        """The name in the catalog."""
        return f"`{self.name}_{layer}`.`{table}`"

    def in_catalog(self, layer: str) -> bool:
        return layer != "bronze" and self.fmt != "delta"

    def exists(self, spark: SparkSession, layer: str, table: str) -> bool:
        """Whether there is anything to read."""
        if self.in_catalog(layer):
            return spark.catalog.tableExists(self.table(layer, table))
        names = storage.children(spark, self.path(layer, table))
        known = (STREAM_FILE_LOG, "_delta_log")
        return any(name in known or not name.startswith("_") or name.startswith(f"{STREAM_BATCH}=") for name in names)

    def has_batches(self, spark: SparkSession, layer: str, table: str) -> bool:
        """Whether a stream writes the table micro-batch by micro-batch."""
        names = storage.children(spark, self.path(layer, table))
        return any(name.startswith(f"{STREAM_BATCH}=") for name in names)

    def current(self, spark: SparkSession, layer: str, table: str) -> str:
        """The directory of the table's files."""
        if not self.in_catalog(layer) or not self.exists(spark, layer, table):
            return self.path(layer, table)
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {self.table(layer, table)}")
        return described.filter("col_name = 'Location'").first()["data_type"]

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        if self.in_catalog(layer):
            return spark.table(self.table(layer, table)).drop(BUCKET)
        return spark.read.format(self.fmt).load(self.path(layer, table)).drop(STREAM_BATCH)

    # -- writing ----------------------------------------------------------------

    def write(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        mode: str = "append",
        partition_by: Sequence[str] = (),
        max_records_per_file: int | None = None,
    ) -> None:
        """Write with a save mode; partition columns only where given."""
        spark, path = df.sparkSession, self.path(layer, table)
        if not self.in_catalog(layer):
            if storage.exists(spark, f"{path}/{STREAM_FILE_LOG}"):
                raise ValueError(f"{layer} table {table} is written by a stream, whose readers would not see other files")
            if self.has_batches(spark, layer, table):
                raise ValueError(f"{layer} table {table} is written by a stream, batch by batch")
            self._save(df, path, mode, partition_by, max_records_per_file)
        elif mode == "overwrite" or not self.exists(spark, layer, table):
            self._replace(df, layer, table, partition_by, max_records_per_file)
        elif mode == "append":
            with sized_for_writing(df):
                df.select(*spark.table(self.table(layer, table)).columns).write.insertInto(self.table(layer, table))
        elif mode != "ignore":
            raise ValueError(f"there is a {layer} table {table}")

    def overwrite_merged(self, df: DataFrame, layer: str, table: str) -> None:
        """Replace the rows; the table keeps its columns and gains new ones, and types are widened to hold both."""
        spark = df.sparkSession
        if self.fmt == "delta":
            self._save(df, self.path(layer, table), "overwrite", mergeSchema="true")
            return
        if self.exists(spark, layer, table):
            df = enforce_schema(df, merge_schemas(self.read(spark, layer, table).schema, df.schema), cast=True)
        self._replace(df, layer, table)

    def overwrite_replaced(self, df: DataFrame, layer: str, table: str) -> None:
        """Replace the rows and the schema."""
        if self.fmt == "delta":
            self._save(df, self.path(layer, table), "overwrite", overwriteSchema="true")
            return
        self._replace(df, layer, table)

    # -- buckets ------------------------------------------------------------------

    def create_bucketed(self, spark: SparkSession, layer: str, table: str, schema: StructType) -> None:
        """An empty table for ``replace_buckets``, unless it is there."""
        if self.fmt == "delta":
            raise ValueError("a Delta table takes changed rows by its own MERGE")
        if not self.exists(spark, layer, table):
            columns = f"{_ddl(schema)}, `{BUCKET}` INT"
            definition = f"{self.table(layer, table)} ({columns}) USING parquet PARTITIONED BY (`{BUCKET}`)"
            self._create(spark, layer, f"{definition} LOCATION '{self.path(layer, table)}'")

    def version(self, spark: SparkSession, layer: str, table: str) -> int:
        """What ``replace_buckets`` was last done up to; -1 before the first time."""
        if not self.exists(spark, layer, table):
            return -1
        return int(self._properties(spark, layer, table).get(_VERSION, -1))

    def unfinished(self, spark: SparkSession, layer: str, table: str) -> int | None:
        """A version that has all its rows written, but whose writer died before all buckets were pointed at them."""
        markers = storage.matching(spark, f"{self.path(layer, table)}/*/_SUCCESS")
        versions = [int(marker.split("/")[-2]) for marker in markers]
        return min((v for v in versions if v > self.version(spark, layer, table)), default=None)

    def replace_buckets(
        self, spark: SparkSession, layer: str, table: str, version: int, rows: Callable[[], DataFrame] | None = None
    ) -> None:
        """Replace the buckets that ``rows()`` (with a column ``_bucket``) has, as a version of the table.

        First the rows are written, then each bucket is pointed at them, then the table has the version. A job that
        dies while it writes has changed nothing; one that dies later is finished by the same call, which finds the
        rows written and doesn't compute them again. What a bucket had before stays until it is replaced again.
        """
        path, name = self.path(layer, table), self.table(layer, table)
        new = f"{path}/{version:012d}"
        if not storage.exists(spark, f"{new}/_SUCCESS"):
            self._save(rows().hint("rebalance", BUCKET), new, "overwrite", [BUCKET])
        replaced = [found for found in storage.subdirectories(spark, new) if found.startswith(f"{BUCKET}=")]
        for bucket in replaced:
            spec = f"PARTITION (`{BUCKET}`={bucket.split('=', 1)[1]})"
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec} LOCATION '{new}/{bucket}'")
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{new}/{bucket}'")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_VERSION}' = '{version}')")
        for bucket in replaced:
            for old in storage.matching(spark, f"{path}/*/{bucket}")[:-2]:
                storage.delete(spark, old)

    # -- compaction -----------------------------------------------------------------

    def compact(
        self,
        spark: SparkSession,
        layer: str,
        table: str,
        file_bytes: int = DEFAULT_FILE_BYTES,
        cluster_by: Sequence[str] = (),
        interleave: Sequence[str] = (),
    ) -> None:
        """Rewrite a table of many small files as files of about ``file_bytes``.

        ``cluster_by`` are the columns whose ranges its files hold, if they do: they hold ranges again then. With
        ``interleave``, files hold ranges of all these columns at once (see ``operators.clustering``). Of a
        partitioned bronze table only partitions in which files of under half that size can be put together are
        rewritten, each by Spark's dynamic partition overwrite; of those, larger files' rows are read and written too.
        """
        path = self.current(spark, layer, table)
        if self.fmt == "delta":
            columns = interleave or cluster_by
            spark.sql(f"OPTIMIZE delta.`{path}`" + (f" ZORDER BY ({', '.join(columns)})" if columns else ""))
            return
        if storage.exists(spark, f"{path}/{STREAM_FILE_LOG}"):
            raise ValueError(f"{path} is written by a stream, whose file log a rewrite would void")
        if not self.in_catalog(layer) and self.has_batches(spark, layer, table):
            raise ValueError(f"{path} is written by a stream, whose readers would read rewritten files again")

        session = _compacting(spark, file_bytes)
        df = session.read.parquet(path)
        if partition_by := _partition_columns(spark, path, df.schema):
            small = _fragmented(df, partition_by, file_bytes)
            if not small:
                return
            # Rows of one partition value meet, but a value with many rows is split.
            chosen = df.filter(" OR ".join(f"({one})" for one in small)).hint("rebalance", *partition_by)
            writer = chosen.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*partition_by).parquet(path)
            return
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        files = max(1, -(-size // file_bytes))
        if interleave:
            df = interleaved(df, interleave, files)
        elif cluster_by:
            df = df.repartitionByRange(files, *cluster_by).sortWithinPartitions(*cluster_by)
        # Otherwise no shuffle: the scan packs small files into one task each.
        if not self.in_catalog(layer):
            raise ValueError(f"{layer} table {table} has no partitions that could be replaced one by one")
        self._replace(df, layer, table)

    # -- steps ----------------------------------------------------------------------

    def _save(
        self,
        df: DataFrame,
        path: str,
        mode: str,
        partition_by: Sequence[str] = (),
        max_records_per_file: int | None = None,
        **options: str,
    ) -> None:
        writer = df.write.format(self.fmt).mode(mode).options(**options)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if max_records_per_file is not None:
            writer = writer.option("maxRecordsPerFile", max_records_per_file)
        with sized_for_writing(df):
            writer.save(path)

    def _properties(self, spark: SparkSession, layer: str, table: str) -> dict[str, str]:
        return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {self.table(layer, table)}").collect()}

    def _create(self, spark: SparkSession, layer: str, definition: str) -> None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.name}_{layer}` LOCATION '{self.root(layer)}'")
        spark.sql(f"CREATE TABLE {definition}")

    def _replace(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        partition_by: Sequence[str] = (),
        max_records_per_file: int | None = None,
    ) -> None:
        """A new directory, then one step of the catalog; of a table whose columns change or that has partitions, two."""
        spark, name = df.sparkSession, self.table(layer, table)
        new = storage.qualified(spark, f"{self.path(layer, table)}/{uuid.uuid4()}")
        self._save(df, new, "error", partition_by, max_records_per_file)
        before = stale = None
        if self.exists(spark, layer, table):
            before = self.current(spark, layer, table)
            stale = self._properties(spark, layer, table).get(_BEFORE)
            same = spark.table(name).schema.simpleString() == spark.read.parquet(new).schema.simpleString()
            if same and not partition_by:
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{new}'")
            else:
                spark.sql(f"DROP TABLE {name}")  # not its files
        if not self.exists(spark, layer, table):
            parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
            definition = f"{name} ({_ddl(spark.read.parquet(new).schema)}) USING parquet{parts}"
            self._create(spark, layer, f"{definition} LOCATION '{new}'")
            if partition_by:
                spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        if before:
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_BEFORE}' = '{before}')")
        if stale:
            storage.delete(spark, stale)


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)


def _compacting(spark: SparkSession, file_bytes: int) -> SparkSession:
    """A session of its own, as these settings are meant for one job."""
    session = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.parquet.outputTimestampType"):
        session.conf.set(name, spark.conf.get(name))
    session.conf.set("spark.sql.files.maxPartitionBytes", str(file_bytes))
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(file_bytes))
    return session


def _fragmented(df: DataFrame, partition_by: Sequence[str], file_bytes: int) -> list[str]:
    """Filters for the partitions in which two small files at least fit one; from the files' own sizes, no row is read."""
    files = df.select(*partition_by, "_metadata.file_path", "_metadata.file_size").distinct()
    small = files.filter(f"file_size < {file_bytes // 2}").groupBy(*partition_by).count().filter("count > 1")

    def equals(column: str, value: object) -> str:
        return f"`{column}` IS NULL" if value is None else f"`{column}` = {value if isinstance(value, int) else repr(str(value))}"

    return [" AND ".join(equals(c, row[c]) for c in partition_by) for row in small.collect()]


def _partition_columns(spark: SparkSession, path: str, schema: StructType) -> list[str]:
    """Partition columns, outermost first, as the directory names below ``path`` show."""
    columns: list[str] = []
    while True:
        names = [name for name in storage.subdirectories(spark, path) if "=" in name]
        if not names:
            return columns
        column = names[0].split("=", 1)[0]
        if column not in schema.fieldNames():
            return columns
        columns.append(column)
        path = f"{path}/{names[0]}"
