"""Filter interaction audit: what each of five filters removes, in every order they could run in.

A document's failures are a mask of filters. In a given order the first filter of the mask removes it. All orders
that begin with the same letters are neighbours in lexicographic order, so those in which a mask is removed at a
given step cover a few intervals of ranks: one for each prefix of passed filters and the failed one after it, whose
first rank is the prefix's Lehmer code. Only masks are counted over the documents; a part's counts are added at the
ends of their intervals in a difference array, and a prefix sum over the 120 ranks gives every order's totals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.common import WORD, extended, in_batches, slices, utf8, with_columns

LETTERS = "ABCDE"
#: In lexicographic order: the place is the rank.
ORDERS = ["".join(order) for order in permutations(LETTERS)]
LEAST_WORDS = 200
#: Per cent of the words that are different at least, and of the characters that are capitals at most.
LEAST_DISTINCT, MOST_CAPITALS = 50, 2
SYMBOLS = b"#$%&*|"

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_FOLLOWING = bytes(range(0x80, 0xC0))
_COPY = 1 << LETTERS.index("E")
#: Null ids are without labels; so many parts keep them from meeting in one task of the join.
_NULL_PARTS = 1024


def rank(prefix: str, letters: str = LETTERS) -> int:
    """Of the first order that begins with these letters: the Lehmer code, in factorials."""
    left, found = list(letters), 0
    for letter in prefix:
        place = left.index(letter)
        del left[place]
        found += place * factorial(len(left))
    return found


def intervals(letters: str = LETTERS) -> np.ndarray:
    """Rows (mask, step from 0, first rank, end rank): the orders in which the mask is removed at the step."""
    rows = []
    for mask in range(1, 1 << len(letters)):
        failed = [letter for k, letter in enumerate(letters) if mask >> k & 1]
        passed = [letter for letter in letters if letter not in failed]
        for step in range(len(passed) + 1):
            for before in permutations(passed, step):
                for letter in failed:
                    first = rank("".join(before) + letter, letters)
                    rows.append((mask, step, first, first + factorial(len(letters) - step - 1)))
    return np.array(rows, dtype=np.int64)


def own_failures(text: bytes) -> int:
    """Mask of the filters that look at the text alone, bit 0 being A."""
    words = text.split()
    n_words, n_distinct = len(words), len(set(words))
    del words
    n_chars = len(text.translate(None, _FOLLOWING))
    n_capitals = len(text) - len(text.translate(None, _CAPITALS))
    has_symbol = len(text.translate(None, SYMBOLS)) < len(text)
    return (
        (n_words < LEAST_WORDS)
        | (100 * n_distinct < LEAST_DISTINCT * n_words) << 1
        | (100 * n_capitals > MOST_CAPITALS * n_chars) << 2
        | has_symbol << 3
    )


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text_hash, mask) of every row, the mask without the copies' filter."""
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text"),
    )
    keep = ["doc_id", "part"]

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = utf8(batch, "text")
            added = {
                "text_hash": pa.array([hashlib.sha256(text).digest()[:16] for text in texts], pa.binary()),
                "mask": pa.array([own_failures(text) for text in texts], pa.int32()),
            }
            yield with_columns(batch, keep, added)

    return in_batches(rows, job, extended(rows, keep, "text_hash binary, mask int"))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with what the labels say, of several of an id any; ids without labels, and null ones, are neither."""
    said = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id"))
    said = said.agg(*[F.coalesce(F.bool_or(F.col(c) == 1), F.lit(False)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text_hash", "part"), F.lit(_NULL_PARTS))).otherwise(F.lit(0))
    same = (F.col("doc_id") == F.col("_id")) & (spread == F.col("_zero"))
    joined = rows.join(said.withColumn("_zero", F.lit(0).cast("long")), same, "left")
    return joined.fillna(False, ["good", "toxic"])


def counted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part that fail just the filters of the mask.

    E is failed by all documents of a text but those with its smallest id. It is found by counting: the rows of a
    text are added up for each part and label, with the smallest id there, before the texts' groups meet, so that
    however many copies a text has, no task gets more than one row of each part and label.
    """
    same_row = ["doc_id", "part", "text_hash", "mask"]
    rows = _labelled(measured(docs).groupBy(*same_row).agg(F.count("*").alias("n")), labels)
    known = F.col("doc_id").isNotNull()
    groups = rows.groupBy("text_hash", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("without_id"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("least"),
    )
    first = F.min("least.doc_id").over(Window.partitionBy("text_hash"))
    originals = F.col("without_id") + F.when(F.col("least.doc_id") == first, F.col("least.n")).otherwise(0)
    split = groups.withColumn("originals", originals).select(
        "part",
        "good",
        "toxic",
        F.inline(
            F.array(
                F.struct(F.col("mask"), F.col("originals").alias("n")),
                F.struct(F.col("mask").bitwiseOR(_COPY).alias("mask"), (F.col("n") - F.col("originals")).alias("n")),
            )
        ),
    )

    def total(label: str) -> Column:
        return F.sum(F.when(F.col(label), F.col("n")).otherwise(0)).alias(label)

    return split.filter("n > 0").groupBy("part", "mask").agg(F.sum("n").alias("n"), total("good"), total("toxic"))


_COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in _COLUMNS)


def totals(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Columns by (rank, step) from a part's counts by (mask; n, good, toxic)."""
    n = len(LETTERS)
    mask, step, first, end = intervals().T
    differences = np.zeros((n, len(ORDERS) + 1, 3), dtype=np.int64)
    np.add.at(differences, (step, first), counts[mask])
    np.subtract.at(differences, (step, end), counts[mask])
    removed, good, toxic = np.cumsum(differences, axis=1)[:, :-1].transpose(2, 1, 0)
    filters = np.array([[LETTERS.index(letter) for letter in order] for order in ORDERS])
    masks = np.arange(1 << n)
    fails = np.array([counts[masks >> k & 1 == 1, 0].sum() for k in range(n)])
    return {
        "kept": counts[:, 0].sum() - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": fails[filters] - removed,
        "unique_fails": counts[1 << filters, 0],
        "good_lost": good,
        "toxic_lost": toxic,
        "shapley": np.bincount(filters.ravel(), removed.ravel(), n).astype(np.int64)[filters],
    }


def audit(counts: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, ...) of each part, order and step from the counts of its masks.

    A part has at most 32 rows here, whatever its documents.
    """

    def job(frame: pd.DataFrame) -> pd.DataFrame:
        of_part = np.zeros((1 << len(LETTERS), 3), dtype=np.int64)
        of_part[frame["mask"]] = frame[["n", "good", "toxic"]]
        rows = pd.DataFrame({name: values.ravel() for name, values in totals(of_part).items()})
        rows.insert(0, "step", np.tile(np.arange(1, len(LETTERS) + 1), len(ORDERS)))
        rows.insert(0, "filter_order", np.repeat(ORDERS, len(LETTERS)))
        rows.insert(0, "part", frame["part"].iloc[0])
        return rows

    return counts.groupBy("part").applyInPandas(job, _SCHEMA)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For every part (source), order of the filters and step: documents kept, removed and so on, zeros included.

    ``docs`` has doc_id, text and source, ``labels`` doc_id, quality and toxic. Null texts are empty, a null source
    is the empty string. Documents without an id have no labels and are nobody's copy or original; rows that share
    an id and a text are originals or copies together, and each counts. Of several labels of an id one that says 1
    is enough. Other columns are ignored. No documents give no rows. ``shapley`` is the filter's removals summed
    over all 120 orders.
    """
    return audit(counted(docs, labels))


def oracle() -> str:
    """The same, every order gone through filter by filter, as SQL for DuckDB."""
    letter = "unnest(['" + "', '".join(LETTERS) + "'])"
    fails = " || ".join(f"CASE WHEN {name.lower()} THEN '{name}' ELSE '' END" for name in LETTERS)
    return f"""
        WITH d AS (
          SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
            regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents
        ),
        l AS (
          SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
          FROM labels GROUP BY doc_id
        ),
        checked AS (
          SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
            len(words) < {LEAST_WORDS} AS a,
            100 * len(list_distinct(words)) < {LEAST_DISTINCT} * len(words) AS b,
            100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(text) AS c,
            regexp_matches(text, '[{SYMBOLS.decode()}]') AS d,
            coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
          FROM d LEFT JOIN l USING (doc_id)
        ),
        failed AS (
          SELECT part, {fails} AS fails, count(*) AS n, count(*) FILTER (WHERE good) AS good,
            count(*) FILTER (WHERE toxic) AS toxic
          FROM checked GROUP BY ALL
        ),
        letters AS (SELECT {letter} AS x),
        orders AS (
          SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
          FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
          JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)
        ),
        gone AS (
          SELECT failed.*, filter_order, step, filter_order[step] AS filter, contains(fails, filter) AS fails_it,
            coalesce(list_min([strpos(filter_order, f) FOR f IN string_split(fails, '') IF f <> '']), 6) AS gone_at
          FROM failed, orders, range(1, 6) AS steps(step)
        ),
        stepped AS (
          SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter,
            CAST(coalesce(sum(n) FILTER (WHERE gone_at > step), 0) AS BIGINT) AS kept,
            CAST(coalesce(sum(n) FILTER (WHERE gone_at = step), 0) AS BIGINT) AS removed,
            CAST(coalesce(sum(n) FILTER (WHERE fails_it AND gone_at < step), 0) AS BIGINT) AS redundant,
            CAST(coalesce(sum(n) FILTER (WHERE fails = filter), 0) AS BIGINT) AS unique_fails,
            CAST(coalesce(sum(good) FILTER (WHERE gone_at = step), 0) AS BIGINT) AS good_lost,
            CAST(coalesce(sum(toxic) FILTER (WHERE gone_at = step), 0) AS BIGINT) AS toxic_lost
          FROM gone GROUP BY ALL
        )
        SELECT * EXCLUDE (filter), CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM stepped"""
