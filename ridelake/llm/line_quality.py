"""Quality rules: counts within a document, and lines that too many documents of a host share.

A line is normalised (ASCII and other capitals to small letters, white space to single spaces) and hashed. For
each host the documents that have it are counted. Lines in more than ``line_docs`` documents of the host are removed,
a number that is the same for hosts of any size, so that a line once over the limit stays over it as the host grows;
documents left with less than ``least_left`` of their words are rejected. With ``count_copies``, as the query has it,
exact copies of a text count each, so that a text in more copies than that goes whole; without, all copies are one
document, for tables whose duplicates are settled elsewhere. A row that repeats, id and all, is one document either way.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import BLANKS, WORD, checkpointed, extended, in_batches, slices, utf8, with_columns

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: Shared lines are broadcast up to this many, some MB; more are joined by a shuffle.
BROADCAST_LINES = 200_000

_BYTES = np.arange(256)
_IS_CHAR = ((_BYTES & 0xC0) != 0x80) & ~np.isin(_BYTES, [32, *range(9, 14)])
_IS_SYMBOL = np.isin(_BYTES, list(SYMBOLS))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _per_text(mask: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return np.diff(total[ends], prepend=0)


def repeated_words(words: list[list[bytes]]) -> np.ndarray:
    """For each text the words in windows of ``WINDOW`` words that are found twice or more in it, the first included."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends, n = np.cumsum(sizes), int(sizes.sum())
    if n < WINDOW:
        return np.zeros(len(words), dtype=np.int64)
    hashes = np.fromiter(map(hash, chain.from_iterable(words)), np.int64, n).view(np.uint64)
    text = np.repeat(np.arange(len(words), dtype=np.uint64), sizes)
    windows = text[: n - WINDOW + 1].copy()
    for k in range(WINDOW):
        windows = windows * _MULTIPLIER + hashes[k : n - WINDOW + 1 + k]
    inside = np.flatnonzero(text[: n - WINDOW + 1] == text[WINDOW - 1 :])
    order = np.argsort(windows[inside], kind="stable")
    ranked = windows[inside][order]
    same = ranked[1:] == ranked[:-1]
    twice = inside[order[np.append(same, False) | np.append(False, same)]]
    edges = np.zeros(n + 1, dtype=np.int64)
    edges[twice] += 1
    edges[twice + WINDOW] -= 1
    return _per_text(np.cumsum(edges[:-1]) > 0, ends)


def measures(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Counts for each UTF-8 text."""
    words = [text.split() for text in texts]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    lines = [[line for line in text.split(b"\n") if line.strip()] for text in texts]
    return {
        "n_words": np.fromiter(map(len, words), np.int64, len(words)),
        "word_chars": _per_text(_IS_CHAR[data], ends),
        "n_symbols": _per_text(_IS_SYMBOL[data], ends),
        "n_dup_lines": np.array([len(found) - len(set(found)) for found in lines], dtype=np.int64),
        "n_repeat_words": repeated_words(words),
    }


_KEYS = ["doc_id", "host", "text_hash"]
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measured(rows: DataFrame) -> DataFrame:
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = measures(utf8(batch, "text"))
            yield with_columns(batch, _KEYS, {name: pa.array(found[name]) for name in _COUNTS})

    return in_batches(rows, job, extended(rows, _KEYS, ", ".join(f"{name} long" for name in _COUNTS)))


def _hashed_line(line: Column) -> Column:
    """Of a normalised line; null if there is no word in it."""
    plain = F.trim(F.lower(F.regexp_replace(line, f"[{BLANKS}]+", " ")))
    return F.when(plain != "", F.xxhash64(plain))


def _lines() -> Column:
    return F.split("text", "\n")


def shared_lines(rows: DataFrame, line_docs: int, count_copies: bool = False) -> DataFrame:
    """(host, line) of the lines that more documents of a host share than allowed.

    A document is a text, or with ``count_copies`` a text and its id; texts that are equal and have no id are one.
    """
    hashes = F.filter(F.array_distinct(F.transform(_lines(), _hashed_line)), F.isnotnull)
    document = F.xxhash64("doc_id", "text_hash") if count_copies else F.col("text_hash")
    lines = rows.select("host", document.alias("document"), F.explode(hashes).alias("line"))
    counts = lines.distinct().groupBy("host", "line").agg(F.count("*").alias("docs"))
    return counts.filter(F.col("docs") > line_docs).select("host", "line")


def _removed(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """Words in shared lines of each document that has some; rows that repeat count once."""
    shared = checkpointed(shared.withColumnsRenamed({"host": "_host", "line": "_line"}))
    if shared.count() <= BROADCAST_LINES:
        shared = F.broadcast(shared)
    lines = rows.select(*_KEYS, F.posexplode(_lines()).alias("at", "line"))
    lines = lines.select(*_KEYS, "at", F.regexp_count("line", F.lit(WORD)).alias("words"), _hashed_line(F.col("line")).alias("line"))
    hit = lines.join(shared, (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host")))
    once = hit.groupBy(*_KEYS, "at").agg(F.first("words").alias("words"))
    return once.groupBy(*_KEYS).agg(F.sum("words").cast("long").alias("n_removed_words"))


def quality_rules(
    docs: DataFrame,
    host: str = "source",
    line_docs: int = 20,
    least_left: float = 0.5,
    count_copies: bool = False,
) -> DataFrame:
    """doc_id, counts, base_failed, n_removed_words and kept of each row.

    Null texts have no words; so they and empty ones fail for too few. A null host is a host like any other. Rows
    that repeat are returned as often. Columns other than doc_id, text and the host's are ignored. No rows give none.
    """
    rows = docs.select(
        "doc_id",
        F.col(host).cast("string").alias("host"),
        F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    removed = _removed(rows, shared_lines(rows, line_docs, count_copies)).withColumnsRenamed({k: f"_{k}" for k in _KEYS})
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in _KEYS]
    counted = _measured(rows).join(removed, same, "left")
    left = F.col("n_words") - F.coalesce("n_removed_words", F.lit(0))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.select(
        "doc_id",
        *_COUNTS,
        failed.alias("base_failed"),
        F.coalesce("n_removed_words", F.lit(0)).alias("n_removed_words"),
        (~failed & (left >= least_left * F.col("n_words"))).alias("kept"),
    )


def oracle(line_docs: int = 20, least_left: float = 0.5) -> str:
    """The same without ``count_copies`` over documents with ids of their own, as SQL for DuckDB."""
    return f"""
        WITH d AS (SELECT doc_id, source AS host, text AS raw, coalesce(text, '') AS text FROM documents),
        w AS (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS words, text FROM d),
        windows AS (
          SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS five
          FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)
        ),
        twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1),
        repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) AS r(k) GROUP BY doc_id),
        lines AS (SELECT doc_id, host, raw, unnest(string_split(text, chr(10))) AS line FROM d),
        duplicates AS (
          SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id
        ),
        normal AS (
          SELECT *, trim(lower(regexp_replace(line, '[{BLANKS}]+', ' ', 'g'))) AS plain,
            len(regexp_extract_all(line, '{WORD}')) AS words
          FROM lines
        ),
        shared AS (
          SELECT host, plain FROM normal WHERE plain <> '' GROUP BY host, plain HAVING count(DISTINCT raw) > {line_docs}
        ),
        removed AS (
          SELECT doc_id, sum(words) AS n FROM normal n
          JOIN shared s ON n.host IS NOT DISTINCT FROM s.host AND n.plain = s.plain GROUP BY doc_id
        ),
        counted AS (
          SELECT w.doc_id, len(words) AS n_words,
            CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
            coalesce(duplicates.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
            CAST(coalesce(removed.n, 0) AS BIGINT) AS n_removed_words
          FROM w LEFT JOIN repeated USING (doc_id) LEFT JOIN duplicates USING (doc_id) LEFT JOIN removed USING (doc_id)
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_words,
          NOT base_failed AND n_words - n_removed_words >= {least_left} * n_words AS kept
        FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)"""
