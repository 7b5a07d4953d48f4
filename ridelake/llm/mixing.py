"""Mixing sources to target weights, in blocks that a splitting tree deals to output shards.

Each source's documents fall into blocks of about equal words by a hash. A source's target is a number of whole
passes over its blocks, and in one more pass a quota of blocks; of those after the quota as many as hold the rest of the
target, in documents that fit it, are taken in part. Each pass has an order of its own, an affine permutation. The
draws, one for each pass and block, are dealt to shards by a tree over ranges of shards: at each node the sources'
counts are split between the two halves by a multivariate hypergeometric draw, so that every shard has its exact
number of blocks and the whole is as likely as any dealing. A shard's draws of a source are consecutive in the
pass's permuted order, so no two shards share one; rows are shuffled within their shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridelake.llm.common import WORD, checkpointed, copies_numbered, row_hashes

#: Words of a block, and of a shard, about.
BLOCK_WORDS, SHARD_WORDS = 1 << 16, 1 << 24
#: Sources a mix may have: their totals and quotas are held by the driver.
MOST_SOURCES = 100_000
#: Small tables are broadcast up to this many rows.
BROADCAST_ROWS = 500_000
#: Numbers of the tree's nodes that the driver hands to tasks at most.
_HANDED = 1 << 21
_RUN = 1024


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: Sequence[int], weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> list[float]:
    """Words wanted of each source, the weights repeating; what goes beyond ``most`` times a size is shared again."""
    wanted, left, open_ = [0.0] * len(sizes), share * sum(sizes), list(range(len(sizes)))
    while open_:
        total = sum(weights[k % len(weights)] for k in open_)
        for k in open_:
            wanted[k] = left * weights[k % len(weights)] / total
        over = [k for k in open_ if wanted[k] > most * sizes[k]]
        for k in over:
            wanted[k] = most * sizes[k]
            left -= wanted[k]
        if not over:
            break
        closed = set(over)
        open_ = [k for k in open_ if k not in closed]
    return wanted


@dataclass
class Source:
    """``passes`` over all blocks; in the next, those before ``quota``, and ``room`` words of the ``edge`` ones from it."""

    index: int
    name: str | None
    size: int
    target: float
    blocks: int
    passes: int
    rest: float
    quota: int = 0
    room: float = 0.0
    edge: int = 0

    @property
    def draws(self) -> int:
        return self.passes * self.blocks + self.quota + self.edge

    def order(self, epoch: int, seed: int) -> tuple[int, int, int]:
        """(n, step, start) of a pass's order: place p comes as number (p * step + start) mod n."""
        n = self.blocks if epoch < self.passes else self.quota + self.edge
        rng = np.random.default_rng((seed, self.index, epoch))
        steps = iter(lambda: int(rng.integers(1, max(n, 2))), None)
        return n, next(step for step in steps if math.gcd(step, max(n, 1)) == 1), int(rng.integers(0, max(n, 1)))


def _sources(sizes: DataFrame, options: dict) -> list[Source]:
    totals = sizes.groupBy("source").agg(F.sum("size").alias("total"))
    found = totals.limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    found.sort(key=lambda row: (row["source"] is None, row["source"] or ""))
    wanted = targets([row["total"] for row in found], **options)
    out = []
    for k, (row, target) in enumerate(zip(found, wanted, strict=True)):
        size = row["total"]
        passes = int(target / size + 1e-12) if size else 0
        out.append(
            Source(k, row["source"], size, target, max(1, math.ceil(size / BLOCK_WORDS)), passes, target - passes * size)
        )
    return out


def _source_table(spark: SparkSession, sources: list[Source], seed: int = 0) -> DataFrame:
    rows = [
        (s.name, s.index, s.size, s.target, s.blocks, s.passes, s.rest, s.quota, s.room, s.edge)
        + ([s.order(epoch, seed) for epoch in range(s.passes + 1)],)
        for s in sources
    ]
    schema = (
        "_source string, _index int, source_size long, target double, _blocks long, _passes int, _rest double, "
        "_quota long, _room double, _edge long, _orders array<struct<n:long,step:long,start:long>>"
    )
    return F.broadcast(spark.createDataFrame(rows, schema))


def _placed(docs: DataFrame, spark: SparkSession, sources: list[Source], seed: int) -> DataFrame:
    """Rows (with ``_source_name``, ``_draws_by`` and ``size``) with their source's numbers and the place of their block."""
    joined = docs.join(_source_table(spark, sources, seed), F.col("_source_name").eqNullSafe(F.col("_source")))
    return joined.withColumn("_place", F.pmod(F.col("_draws_by"), F.col("_blocks")))


def _reached(blocks: DataFrame, wanted: str) -> DataFrame:
    """(_index, words, end) of each source: the words of the blocks that come before its number ``wanted`` is passed,
    and the first that passes it; by prefix sums over runs of blocks."""
    runs = blocks.withColumn("run", F.floor(F.col("_place") / _RUN))
    whole = runs.groupBy("_index", "run").agg(F.sum("words").alias("run_words"))
    ahead = F.sum("run_words").over(Window.partitionBy("_index").orderBy("run")) - F.col("run_words")
    starts = whole.select("_index", "run", ahead.alias("start"))
    within = F.sum("words").over(Window.partitionBy("_index", "run").orderBy("_place"))
    summed = runs.withColumn("within", within).join(starts, ["_index", "run"]).withColumn("upto", F.col("start") + F.col("within"))
    fits = F.col("upto") <= F.col(wanted)
    return summed.groupBy("_index").agg(
        F.max(F.when(fits, F.col("upto"))).alias("words"), F.min(F.when(~fits, F.col("_place"))).alias("end")
    )


def _with_quotas(slim: DataFrame, spark: SparkSession, sources: list[Source], seed: int) -> None:
    """Sets each source's quota, the blocks that fit the rest of its target, and the edge: as many blocks after them
    as hold what is left to fill, in documents that fit it."""
    blocks = _placed(slim, spark, sources, seed).filter("_rest > 0").groupBy("_index", "_place", "_rest")
    for row in _reached(blocks.agg(F.sum("size").alias("words")), "_rest").collect():
        source = sources[row["_index"]]
        source.quota = source.blocks if row["end"] is None else row["end"]
        source.room = 0.0 if row["end"] is None else source.rest - (row["words"] or 0)
    for source in sources:
        source.edge = source.blocks - source.quota if source.room > 0 else 0
    after = _placed(slim, spark, sources, seed).filter("_room > 0 AND _place >= _quota AND size <= _room")
    fitting = after.groupBy("_index", "_place", "_room").agg(F.sum("size").alias("words"))
    for row in _reached(fitting, "_room").collect():
        source = sources[row["_index"]]
        if row["end"] is not None:
            source.edge = row["end"] + 1 - source.quota


def fill(sizes: np.ndarray, order: np.ndarray, room: float) -> np.ndarray:
    """Which sizes fill a room: the largest that fits comes first; at last one more if that comes nearer."""
    taken = np.zeros(len(sizes), dtype=bool)
    for k in np.lexsort((order, -sizes)).tolist():
        if sizes[k] <= room:
            taken[k] = True
            room -= sizes[k]
    left = np.flatnonzero(~taken)
    if len(left):
        least = left[np.lexsort((order[left], sizes[left]))[0]]
        taken[least] = sizes[least] < 2 * room
    return taken


def _picked(placed: DataFrame) -> DataFrame:
    """(_index, _draws_by, size) of documents that fill the room, from the edges.

    Only numbers are gathered. An edge holds about the words of its room in documents that fit, and a room is less
    than a block's words: ``BLOCK_WORDS``, or those of a giant in it.
    """
    at_edge = F.col("_place").between(F.col("_quota"), F.col("_quota") + F.col("_edge") - 1)
    edge = placed.filter(at_edge & (F.col("size") > 0) & (F.col("size") < 2 * F.col("_room")))

    def pick(frame: pd.DataFrame) -> pd.DataFrame:
        taken = fill(frame["size"].to_numpy(), frame["_draws_by"].to_numpy(), float(frame["_room"].iloc[0]))
        return frame.loc[taken, ["_index", "_draws_by", "size"]]

    slim = edge.select("_index", "_draws_by", "size", "_room")
    return slim.groupBy("_index").applyInPandas(pick, "_index int, _draws_by long, size long")


# -- the splitting tree ---------------------------------------------------------


def _split(low: int, high: int, counts: np.ndarray, capacity: int, extra: int, seed: int):
    """The counts of the left half of the shards from low to high; shards have ``capacity``, the first ``extra`` one more."""
    middle = (low + high) // 2
    room = (middle - low) * capacity + max(0, min(middle, extra) - low)
    rng = np.random.default_rng((seed, low, high))
    return middle, rng.multivariate_hypergeometric(counts, room, method="marginals")


def _leaves(node: tuple, capacity: int, extra: int, seed: int, most: int | None = None) -> Iterator[tuple]:
    """(low, high, first draw of each source, counts) below a node: single shards, or at most ``most`` nodes."""
    level = [node]
    while level and (most is None or len(level) < most) and any(high - low > 1 for low, high, _, _ in level):
        below = []
        for low, high, first, counts in level:
            if high - low <= 1:
                below.append((low, high, first, counts))
                continue
            middle, left = _split(low, high, counts, capacity, extra, seed)
            below += [(low, middle, first, left), (middle, high, first + left, counts - left)]
        level = below
    yield from level


def dealt(spark: SparkSession, sources: list[Source], shards: int, seed: int) -> DataFrame:
    """(_index, _draw, shard) for every draw of every source: the top of the tree here, the rest in tasks."""
    counts = np.array([source.draws for source in sources], dtype=np.int64)
    capacity, extra = divmod(int(counts.sum()), shards)
    most = max(1, min(64, _HANDED // max(len(sources), 1)))
    top = _leaves((0, shards, np.zeros_like(counts), counts), capacity, extra, seed, most=most)
    rows = [(low, high, first.tolist(), own.tolist()) for low, high, first, own in top]
    nodes = spark.createDataFrame(rows, "low long, high long, first array<long>, counts array<long>")

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                node = (row["low"], row["high"], *(np.array(row[name], dtype=np.int64) for name in ("first", "counts")))
                for low, _, first, own in _leaves(node, capacity, extra, seed):
                    index = np.repeat(np.arange(len(own)), own)
                    draw = np.arange(len(index)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(first, own)
                    shard = np.full(len(index), low)
                    arrays = [pa.array(index.astype(np.int32)), pa.array(draw), pa.array(shard)]
                    yield pa.RecordBatch.from_arrays(arrays, ["_index", "_draw", "shard"])

    return nodes.repartition(max(len(rows) // 4, 1)).mapInArrow(job, "_index int, _draw long, shard long")


def _bounded(df: DataFrame) -> DataFrame:
    """Written, and broadcast if it has few rows."""
    df = checkpointed(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """Rows with the source as text, the size and a number of their own that draws their block: equal rows' differ by
    their copy's number, so that no key has many rows."""
    hashes = row_hashes(docs.drop("_copy"), seed)
    return docs.select(
        "*",
        F.col("source").cast("string").alias("_source_name"),
        n_words(F.col("text").cast("string")).alias("size"),
        F.xxhash64(F.lit(seed), *hashes, "_copy").alias("_draws_by"),
    )


def _mixed(docs: DataFrame, spark: SparkSession, seed: int, shard_words: int, options: dict) -> tuple[DataFrame, list[Source]]:
    """A row for every time one is taken, with ``_draws_by``, shard and epoch; and the sources."""
    keyed = _keyed(docs, seed)
    slim = checkpointed(keyed.select("_source_name", "size", "_draws_by"))
    sources = _sources(slim.withColumnRenamed("_source_name", "source"), options)
    _with_quotas(slim, spark, sources, seed)
    picks = _bounded(_picked(_placed(slim, spark, sources, seed)))
    words = sum(source.target for source in sources)
    shards = _bounded(dealt(spark, sources, max(1, math.ceil(words / shard_words)), seed))

    picks = picks.select(F.col("_index").alias("_i"), F.col("_draws_by").alias("_d"), F.col("size").alias("_s"), F.lit(True).alias("_pick"))
    same = [F.col("_index") == F.col("_i"), F.col("_draws_by") == F.col("_d"), F.col("size") == F.col("_s")]
    placed = _placed(keyed, spark, sources, seed).join(picks, same, "left")
    last = (F.col("_place") < F.col("_quota")) | F.coalesce("_pick", F.lit(False))
    turns = F.col("_passes") + last.cast("int")
    drawn = placed.withColumn("epoch", F.explode(F.when(turns > 0, F.sequence(F.lit(0), turns - 1))))
    order = F.col("_orders")[F.col("epoch")]
    number = F.pmod(F.col("_place") * order["step"] + order["start"], order["n"])
    drawn = drawn.withColumn("_draw", F.col("epoch") * F.col("_blocks") + number)
    return drawn.join(shards, ["_index", "_draw"]), sources


def mixture(
    docs: DataFrame,
    spark: SparkSession,
    seed: int = 29,
    shard_words: int = SHARD_WORDS,
    **options,
) -> DataFrame:
    """A row for every time the mix takes a document: its columns, and size, source_size, target, shard, epoch.

    ``options`` are those of ``targets``. Words are counted in whole texts; null texts have none. A null source is
    one of the sources, the last. Rows of a shard are together and in random order. Of rows that repeat some may be
    taken and others not. The taken words of a source are its target but for less than half a document that would
    fit. Documents of no words come along with their block. Reruns agree. Columns called as those added are replaced,
    others may have any names. No documents give no rows.
    """
    columns = [c for c in docs.columns if c not in ("size", "source_size", "target", "shard", "epoch")]
    names = {name: name if name in ("text", "source") else f"c{k}" for k, name in enumerate(columns)}
    own = docs.select(*[F.col(f"`{name}`").alias(alias) for name, alias in names.items()])
    mixed, _ = _mixed(copies_numbered(own, "_copy"), spark, seed, shard_words, options)
    random = F.xxhash64(F.lit(seed), "shard", "epoch", "_draws_by")
    ordered = mixed.withColumn("_random", random).repartition("shard").sortWithinPartitions("shard", "_random")
    back = [F.col(alias).alias(name) for name, alias in names.items()]
    return ordered.select(*back, "size", "source_size", "target", "shard", "epoch")


def taken(docs: DataFrame, spark: SparkSession, seed: int = 29, shard_words: int = SHARD_WORDS, **options) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of each row of ``docs``, the times read off the mixture."""
    slim = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    numbered = copies_numbered(slim, "_copy")
    mixed, sources = _mixed(numbered, spark, seed, shard_words, options)
    times = mixed.groupBy(F.col("_draws_by").alias("_d"), F.col("size").alias("_s")).agg(F.count("*").alias("times"))
    rows = _keyed(numbered, seed).select("doc_id", "source", "size", "_draws_by")
    counted = rows.join(times, [F.col("_draws_by") == F.col("_d"), F.col("size") == F.col("_s")], "left")
    wanted = _source_table(spark, sources).select("_source", "source_size", "target")
    out = counted.join(wanted, F.col("source").eqNullSafe(F.col("_source")))
    words = (F.col("size") * F.coalesce("times", F.lit(0))).cast("long").alias("taken")
    return out.select("doc_id", "source", "size", "source_size", "target", words)
