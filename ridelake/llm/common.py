"""What the operators of this subpackage share: reading texts in bounded slices, checkpoints, folds."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridelake.sources import storage

#: Inside a character class: the six ASCII white-space characters that part words.
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"
BATCH_ROWS = 1000
_ROWS_AT_A_TIME = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Whether a document is in the fifth that no model learns from; a null id is learnt from by none either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; only where that is unset, a new folder in the warehouse, gone with the session."""
    if shared := spark.conf.get("spark.checkpoint.dir", None):
        return shared.rstrip("/")
    own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared-{uuid.uuid4()}"
    storage.must_be_shared(spark, own)
    storage.delete_on_exit(spark, own)
    return own


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows from files in the folder all executors share, so that a lost executor costs no recomputation.

    The folder is that of ``shared_folder``, unless the session has a checkpoint folder already.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def row_hashes(df: DataFrame, seed: int = 0) -> list[Column]:
    """128 bits in two longs that rows share only if they are equal in all columns."""
    fields = [(F.col(f"`{f.name}`"), "map<" in f.dataType.simpleString()) for f in df.schema.fields]
    values = [F.to_json(F.struct(column)) if mapped else column for column, mapped in fields]
    # A null leaves a hash as it is, so which values are null goes in too.
    nulls = F.concat(*[column.isNull().cast("int").cast("string") for column, _ in fields])
    return [F.xxhash64(nulls, *values), F.xxhash64(F.lit(seed), *values, nulls)]


def free_names(df: DataFrame, *names: str) -> list[str]:
    """These names, with underscores before those that the frame has already, whatever the case."""
    taken = {name.lower() for name in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


#: A row that repeats more often than this is dealt to several tasks before its copies are written out.
COPIES_AT_A_TIME = 1 << 14


def copies_numbered(df: DataFrame, name: str) -> DataFrame:
    """The rows with the number of each among those equal to it, from 0, in a column of that name.

    Where no rows are equal, which is counted first, they stay where they are and the number is 0; else equal rows are
    brought together as one, with partial aggregation before the shuffle, and written out again in several tasks.
    """
    one, other, copies, part = free_names(df, "_h", "_g", "_n", "_part")
    hashes = [column.alias(alias) for column, alias in zip(row_hashes(df), (one, other), strict=True)]
    slim = df.select(*hashes).groupBy(one, other).count()
    most = slim.agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    if most <= 1:
        return df.withColumn(name, F.lit(0).cast("long"))
    firsts = [F.first(f"`{column}`").alias(column) for column in df.columns]
    rows = df.select("*", *hashes).groupBy(one, other).agg(*firsts, F.count("*").alias(copies))
    rows = rows.withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({copies} - 1) DIV {COPIES_AT_A_TIME}"))))
    if most > COPIES_AT_A_TIME:
        rows = rows.repartition(one, other, part)
    start = F.col(part) * COPIES_AT_A_TIME
    last = F.least(F.col(copies), start + COPIES_AT_A_TIME) - 1
    return rows.withColumn(name, F.explode(F.sequence(start, last))).select(*[f"`{c}`" for c in df.columns], name)


def in_batches(df: DataFrame, job: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow``, with at most ``BATCH_ROWS`` rows handed over at a time: by default it is ten times as many."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_ROWS_AT_A_TIME)) <= BATCH_ROWS:
        conf.set(_ROWS_AT_A_TIME, str(BATCH_ROWS))
    return df.mapInArrow(job, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in pieces whose texts have about ``most_bytes`` together, or one row; small batches are put together."""
    held: list[pa.RecordBatch] = []
    room = most_bytes
    for batch in batches:
        start = 0
        for row, size in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
            if size > room and (held or row > start):
                yield _joined([*held, batch.slice(start, row - start)])
                held, start, room = [], row, most_bytes
            room -= size
        held.append(batch.slice(start))
    if sum(batch.num_rows for batch in held):
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [text or b"" for text in batch.column(column).cast(pa.binary()).to_pylist()]


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts; null is empty."""
    return [text or "" for text in batch.column(column).to_pylist()]


def with_columns(batch: pa.RecordBatch, keep: list[str], added: dict[str, pa.Array]) -> pa.RecordBatch:
    """Some columns of a batch, and new ones."""
    return pa.RecordBatch.from_arrays([batch.column(name) for name in keep] + list(added.values()), keep + list(added))


def extended(df: DataFrame, keep: list[str], added: str) -> str:
    """The schema, as DDL, of some columns and new ones."""
    kept = ", ".join(f"`{name}` {df.schema[name].dataType.simpleString()}" for name in keep)
    return f"{kept}, {added}" if kept else added


def labelled_sample(
    docs: DataFrame, labels: DataFrame, per_label: int, longest: int = 20_000
) -> list[tuple[object, str]]:
    """(label, text) of at most ``per_label`` documents of each label, to fit a model on.

    ``docs`` has doc_id and text, ``labels`` doc_id and label; of several labels of an id the smallest counts. Ids
    with a small hash are drawn, about twice as many of each label as wanted; of their texts of at most ``longest``
    characters the first by the hash are taken. So the sample depends on the ids alone, and no task and no shuffle
    holds more of a label than that.
    """
    known = labels.filter("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"))
    known = checkpointed(known.withColumn("_order", F.xxhash64("doc_id")))
    sizes = known.groupBy(F.col("label").alias("_label")).agg(F.count("*").alias("_size"))
    joined = known.join(F.broadcast(sizes), F.col("label") == F.col("_label"))
    place = F.pmod("_order", F.lit(1 << 40)) / (1 << 40)
    drawn = joined.filter(place * F.col("_size") < 2 * per_label + 20).select("doc_id", "label", "_order")
    short = docs.select("doc_id", "text").filter(F.length("text") <= longest)
    texts = short.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "label", "_order").agg(F.min("text").alias("text"))
    order = Window.partitionBy("label").orderBy(F.pmod("_order", F.lit(1 << 40)), "doc_id")
    first = texts.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= per_label)
    return [(row["label"], row["text"]) for row in first.orderBy("doc_id").collect()]
