"""SimHash near-duplicates: pairs of fingerprints filtered by pivot distance tables.

The distance to a pivot changes by at most the distance of two fingerprints, so a pair whose distances to any
pivot differ by more than the limit is discarded by its row of the table; survivors are verified bit by bit.
The tables alone would have to look at all pairs, since distances of unrelated fingerprints to a pivot crowd
around half the bits. So they are applied inside buckets: with ``BLOCKS`` blocks of bits and at most ``LIMIT``
differing bits, ``BLOCKS - LIMIT`` blocks at least agree, and a pair meets in the bucket of those. Buckets that
are too full are dealt anew by the blocks of the bits that are still free, so that after three levels no more
than 2^14 different fingerprints can meet, however many documents there are; no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import (
    checkpointed,
    extended,
    free_names,
    in_batches,
    row_hashes,
    slices,
    utf8,
    with_columns,
)
from ridelake.llm.components import components

BITS, LIMIT, BLOCKS = 64, 3, 5
SHINGLE, SEED = 3, 42
#: A bucket with more different fingerprints is dealt anew, LEVELS times in all at most.
FULL, LEVELS = 2048, 3
PIVOTS = np.random.default_rng(20_240_101).integers(0, 2**64, 24, dtype=np.uint64)
_ROWS = 500_000


def _majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes; sums of 255 rows fit a byte."""
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 255 * 256):
        part = hashes[start : start + 255 * 256]
        part = np.concatenate([part, np.zeros(-len(part) % 255, dtype=np.uint64)])
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 255, BITS)
        counts += np.add.reduce(bits, axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash over the shingles of a UTF-8 text: those with fewer words are one shingle, those with none are 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined, width = b" ".join(words), min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)]
    return _majority(np.array(found, dtype=np.uint64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Some columns and the fingerprint, as a signed long, of every row."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values = np.array([fingerprint(text, shingle) for text in utf8(batch, "text")], dtype=np.uint64)
            yield with_columns(batch, list(keep), {"fingerprint": pa.array(values.view(np.int64))})

    rows = docs.select(*keep, F.col("text").cast("string").alias("text"))
    return in_batches(rows, job, extended(rows, list(keep), "fingerprint long"))


def _masks(free: int, limit: int) -> list[int]:
    """Masks of the free bits such that two values with at most ``limit`` differing bits agree under one of them."""
    bits = [1 << b for b in range(BITS) if free >> b & 1]
    blocks = [sum(bits[k * len(bits) // BLOCKS : (k + 1) * len(bits) // BLOCKS]) for k in range(BLOCKS)]
    return [sum(chosen) for chosen in combinations(blocks, BLOCKS - limit)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _keyed(rows: DataFrame, fixed: list[int], limit: int) -> tuple[DataFrame, list[int]]:
    """Every row once for each mask that adds to its own (``table`` is the index of it); and the new masks."""
    masks = [mask | more for mask in fixed for more in _masks(~mask & (1 << BITS) - 1, limit)]
    each = len(masks) // len(fixed)
    choices = F.array(*[F.lit(_signed(mask)) for mask in masks])
    spread = rows.select("fp", F.explode(F.sequence(F.col("table") * each, (F.col("table") + 1) * each - 1)).alias("table"))
    return spread.withColumn("bucket", F.col("fp").bitwiseAND(choices[F.col("table")])), masks


class _Forest:
    """Which rows have been linked so far: a root for each."""

    def __init__(self, size: int) -> None:
        self.root = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            one, other = self.root[a], self.root[b]
            apart = one != other
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(one, other)[apart], np.minimum(one, other)[apart])
            while (up := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = up


def linked(group: np.ndarray, fp: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the pairs of a group within ``limit`` bits join: a forest of them, not all pairs.

    Rows are sorted by group and by the distance to the first pivot, so a row's partners follow it closely.
    """
    first = np.bitwise_count(fp ^ PIVOTS[0]).astype(np.int16)
    order = np.lexsort((first, group))
    group, fp, first = group[order], fp[order], first[order]
    table = [np.bitwise_count(fp ^ pivot).astype(np.int8) for pivot in PIVOTS[1:]]
    forest, alive, lag = _Forest(len(fp)), np.arange(len(fp)), 0
    while True:
        lag += 1
        alive = alive[alive + lag < len(fp)]
        alive = alive[(group[alive] == group[alive + lag]) & (first[alive + lag] - first[alive] <= limit)]
        if not len(alive):
            break
        a, b = alive, alive + lag
        for distances in table:
            close = np.abs(distances[a] - distances[b]) <= limit
            a, b = a[close], b[close]
        near = np.bitwise_count(fp[a] ^ fp[b]) <= limit
        forest.link(a[near], b[near])
    tied = np.flatnonzero(forest.root != np.arange(len(fp)))
    return fp[forest.root[tied]], fp[tied]


def _link_job(limit: int):
    def flushed(rows: list[pa.RecordBatch], whole: bool) -> tuple[pa.RecordBatch | None, list[pa.RecordBatch]]:
        data = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        table, bucket, fp = (data.column(name).to_numpy() for name in ("table", "bucket", "fp"))
        change = np.flatnonzero((table[1:] != table[:-1]) | (bucket[1:] != bucket[:-1])) + 1
        end = len(fp) if whole else int(change[-1]) if len(change) else 0
        if not end:
            return None, [data]
        group = np.zeros(end, dtype=np.int64)
        group[change[change < end]] = 1
        u, v = linked(np.cumsum(group), fp[:end].view(np.uint64), limit)
        found = pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])
        return found, [data.slice(end)]

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= _ROWS:
                found, held = flushed(held, whole=False)
                if found is not None:
                    yield found
        if sum(x.num_rows for x in held):
            yield flushed(held, whole=True)[0]

    return job


def links(distinct: DataFrame, limit: int = LIMIT, full: int = FULL) -> DataFrame:
    """(u, v) links between different fingerprints (column fp) that span every component of the graph of pairs
    within ``limit`` bits."""
    rows, fixed = distinct.select("fp", F.lit(0).alias("table")), [0]
    parts = []
    for level in range(LEVELS):
        keyed, fixed = _keyed(rows, fixed, limit)
        counts = keyed.groupBy("table", "bucket").count().filter("count > 1")
        met = checkpointed(keyed.join(counts, ["table", "bucket"]))
        last = level == LEVELS - 1
        ready = met if last else met.filter(F.col("count") <= full)
        sorted_rows = ready.drop("count").repartition("table", "bucket").sortWithinPartitions("table", "bucket")
        parts.append(in_batches(sorted_rows, _link_job(limit), "u long, v long"))
        rows = met.filter(F.col("count") > full).select("fp", "table").distinct()
        if last or rows.isEmpty():
            break
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _rooted(distinct: DataFrame, limit: int, full: int) -> DataFrame:
    """Rows of different fingerprints (fp) with the root of the component of each."""
    roots = components(links(distinct.select("fp"), limit, full))
    joined = distinct.join(roots, distinct.fp == roots.node, "left")
    return joined.select(*distinct.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, limit: int = LIMIT, shingle: int = SHINGLE, full: int = FULL) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row: fingerprints within ``limit`` bits are linked, and the
    component's id is the smallest doc_id that can be reached.

    Documents of one fingerprint are linked by it, without pairs. Null and empty texts have fingerprint 0 and
    are linked like any other. Repeated rows are returned as often as they come. A null doc_id gets its
    component's id, null only if all in it are null. Other columns are ignored; no rows give no rows.
    """
    rows = checkpointed(fingerprints(docs, shingle))
    distinct = checkpointed(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least")))
    joined = checkpointed(_rooted(distinct, limit, full))
    smallest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = joined.join(smallest, "root").select(F.col("fp").alias("fingerprint"), "component_id")
    return rows.join(labels, "fingerprint").select("doc_id", "fingerprint", "component_id")


def first_of_each(docs: DataFrame, limit: int = LIMIT, shingle: int = SHINGLE, full: int = FULL) -> DataFrame:
    """The documents without near-duplicates: exactly one row of each component, with all columns.

    It is the least by doc_id (those without one last), fingerprint and a hash of the whole row, so that reruns
    agree and different texts of one id are kept apart. Rows without an id, and null and empty texts, are in
    components like all others. Columns may have any names. No rows give no rows.
    """
    one, other, found_one, found_other, copies = free_names(docs, "_h", "_g", "_sh", "_sg", "_copies")
    first, second = row_hashes(docs)
    hashed = docs.select("*", first.alias(one), second.alias(other))
    slim = hashed.select("doc_id", "text", F.col(one).alias("h"), F.col(other).alias("g"))
    rows = checkpointed(fingerprints(slim, shingle, ("doc_id", "h", "g")))
    same = rows.groupBy(F.col("fingerprint").alias("fp"), "doc_id", "h", "g").agg(F.count("*").alias("copies"))
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "fp", "h", "g", "copies")
    distinct = checkpointed(same.groupBy("fp").agg(F.min(order).alias("least")))
    stay = _rooted(distinct, limit, full).groupBy("root").agg(F.min("least").alias("least"))
    names = {"h": found_one, "g": found_other, "copies": copies}
    stay = checkpointed(stay.select(*[F.col(f"least.{name}").alias(alias) for name, alias in names.items()]))
    kept = hashed.join(stay, (F.col(one) == F.col(found_one)) & (F.col(other) == F.col(found_other)))
    if not stay.filter(F.col(copies) > 1).isEmpty():
        once = kept.filter(F.col(copies) > 1).dropDuplicates([one, other])
        kept = kept.filter(F.col(copies) == 1).unionByName(once)
    return kept.select(*[F.col(f"`{name}`") for name in docs.columns])
