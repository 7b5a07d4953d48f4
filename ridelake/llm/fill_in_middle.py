"""Fill-in-middle transformation, by secondary sort.

A task cuts a text into units (a word with the white space before it) and emits it in pieces of whole units, each
keyed by its document and its position in the output. They are partitioned by document and sorted by position
within partitions (``repartition`` and ``sortWithinPartitions``, the DataFrame form of the RDD's
``repartitionAndSortWithinPartitions``), so that the output goes by piece by piece, in order, into an incremental
digest. The way back is the same: the output is read as a stream, its marks are looked for, and what lies between
them is emitted with the position it has in the text, and sorted again. No task holds more of a document than one
piece, but for the one that reads it as a row. Documents that stay as they are need no assembly, so only their digest
travels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import WORD, BLANKS, extended, in_batches, slices, utf8

#: Prefix, suffix and middle, by the letter of the form.
MARKS = {"p": b"<P>", "s": b"<S>", "m": b"<M>"}
_MARK_BYTES = 3
#: The order of the sections in a text, which restoring goes by.
_IN_TEXT = "pms"
SEED, PERCENT, SUFFIX_FIRST = 42, 50, 80
#: A piece ends with the unit that reaches this many bytes, or inside a unit at so many.
PIECE_BYTES = 1 << 15


def unit_ends(text: bytes) -> np.ndarray:
    """Where the units of a UTF-8 text end, in bytes."""
    data = np.frombuffer(text, dtype=np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return np.append(ends, len(data))


def drawn(doc_id: object, seed: int = SEED) -> list[int]:
    """Four numbers of 32 bits for a document; those without an id draw alike."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def form_of(text: bytes, h3: int, h4: int, percent: int = PERCENT, suffix_first: int = SUFFIX_FIRST) -> str:
    """plain, or the sections in the order they are written."""
    if not text or h3 % 100 >= percent or any(mark in text for mark in MARKS.values()):
        return "plain"
    return "spm" if h4 % 100 < suffix_first else "psm"


def _cut(start: int, end: int, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """The range in pieces of whole units, where they aren't longer than a piece."""
    while end - start > PIECE_BYTES:
        k = np.searchsorted(ends, start + PIECE_BYTES)
        stop = min(int(ends[k]), end, start + 2 * PIECE_BYTES)
        yield start, stop
        start = stop
    if end > start:
        yield start, end


def _chars(text: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80))


#: Section -1 is the document's own row, without a piece. ``row`` is that row's number of copies.
_PIECES = {
    "text_hash": pa.binary(),
    "section": pa.int32(),
    "position": pa.int64(),
    "piece": pa.binary(),
    "n": pa.int64(),
    "form": pa.string(),
    "prefix_chars": pa.int64(),
    "middle_chars": pa.int64(),
    "output_sha256": pa.string(),
    "copies": pa.int64(),
}
_DDL = (
    "text_hash binary, section int, position long, piece binary, n long, form string, prefix_chars long, "
    "middle_chars long, output_sha256 string, copies long"
)
_ORDER = ["doc_id", "text_hash", "section", "position"]


def _document(text: bytes, doc_id: object, seed: int, percent: int, suffix_first: int) -> Iterator[tuple]:
    """The rows, without the id, of one document."""
    h1, h2, h3, h4 = drawn(doc_id, seed)
    ends, key = unit_ends(text), xxhash.xxh3_128_digest(text)
    n, form = len(ends), form_of(text, h3, h4, percent, suffix_first)
    if form == "plain":
        yield key, -1, 0, None, n, form, None, None, hashlib.sha256(text).hexdigest(), 1
        return
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (first, second))
    yield key, -1, 0, None, n, form, _chars(text[:a]), _chars(text[a:b]), None, 1
    nothing, position = (None,) * 6, 0
    ranges = {"p": (0, a), "m": (a, b), "s": (b, len(text))}
    for section in form:
        mark = MARKS[section]
        yield key, 0, position, mark, *nothing
        position += len(mark)
        for start, end in _cut(*ranges[section], ends):
            yield key, 0, position, text[start:end], *nothing
            position += end - start


def _batches(rows: Iterable[tuple], id_type: pa.DataType, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of (doc_id, the columns of ``_PIECES``) as batches of bounded size."""
    schema = pa.schema([("doc_id", id_type), *_PIECES.items()])
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 200 + len(row[4] or b"")
        if size > most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def pieces(
    docs: DataFrame, seed: int = SEED, percent: int = PERCENT, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """For each document a row of its own (section -1) and, if it is transformed, those of its output's pieces."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id")
            cut = (
                (doc_id, *row)
                for doc_id, text in zip(ids.to_pylist(), utf8(batch, "text"), strict=True)
                for row in _document(text, doc_id, seed, percent, suffix_first)
            )
            yield from _batches(cut, ids.type)

    return in_batches(rows, job, extended(rows, ["doc_id"], _DDL))


def in_order(rows: DataFrame) -> DataFrame:
    """The documents' rows, each document's together and by section and position."""
    return rows.repartition("doc_id", "text_hash").sortWithinPartitions(*_ORDER)


class Reader:
    """Reads an output as a stream: marks may be cut anywhere by the ends of pieces."""

    def __init__(self, form: str) -> None:
        self.form, self.section, self.rest, self.sizes = form, -1, b"", dict.fromkeys(form, 0)

    def read(self, piece: bytes) -> Iterator[tuple[int, int, bytes]]:
        """(section's place in the text, position within it, bytes) of what the piece adds."""
        data = self.rest + piece
        while self.section + 1 < len(self.form):
            at = data.find(MARKS[self.form[self.section + 1]])
            if at < 0:
                known = max(len(data) - _MARK_BYTES + 1, 0)
                yield from self._found(data[:known])
                self.rest = data[known:]
                return
            yield from self._found(data[:at])
            data = data[at + _MARK_BYTES :]
            self.section += 1
        self.rest = b""
        yield from self._found(data)

    def _found(self, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        if data:
            letter = self.form[self.section]
            yield _IN_TEXT.index(letter), self.sizes[letter], data
            self.sizes[letter] += len(data)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[bytes]]]:
    """Each document's own row, with its copies, and a stream of its pieces; pieces of equal rows come by once."""

    def stream() -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    def once(rows: Iterator[dict]) -> Iterator[bytes]:
        last = None
        for row in rows:
            if (place := (row["section"], row["position"])) != last:
                last = place
                yield row["piece"]

    for _, rows in groupby(stream(), key=itemgetter("doc_id", "text_hash")):
        own, first = None, []
        for row in rows:
            if row["section"] >= 0:
                first = [row]
                break
            if own is None:
                own = row
            else:
                own["copies"] += row["copies"]
        yield own, once(_chained(first, rows))


def _chained(first: list[dict], rest: Iterator[dict]) -> Iterator[dict]:
    yield from first
    yield from rest


def restored(rows: DataFrame) -> DataFrame:
    """From documents' rows in order of output: their own with the output's digest, and pieces with their place in
    the text, found in the output by its form alone."""

    def document(own: dict, stream: Iterator[bytes]) -> Iterator[tuple]:
        key = (own["doc_id"], own["text_hash"])
        nothing = (None,) * 6
        if own["form"] != "plain":
            digest, reader = hashlib.sha256(), Reader(own["form"])
            for piece in stream:
                digest.update(piece)
                for section, position, data in reader.read(piece):
                    yield *key, section, position, data, *nothing
            own["output_sha256"] = digest.hexdigest()
        yield tuple(own.values())

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (row for own, stream in _documents(batches) for row in document(own, stream))
        yield from _batches(found, id_type)

    id_type = pa_type(rows)
    return in_batches(rows, job, rows.schema)


def pa_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["doc_id"].dataType)


_RESULT = (
    "n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
)


def digested(rows: DataFrame) -> DataFrame:
    """From documents' rows in order of text: one row for each document and copy, with both digests."""
    kept = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [rows_schema.field(name) for name in kept] + [pa.field("restored_sha256", pa.string())]
        held: list[tuple] = []
        for own, stream in _documents(batches):
            digest = hashlib.sha256()
            for piece in stream:
                digest.update(piece)
            whole = own["output_sha256"] if own["form"] == "plain" else digest.hexdigest()
            held += [(*[own[name] for name in kept], whole)] * own["copies"]
            if len(held) >= 1000:
                yield _table(held, columns)
                held = []
        if held:
            yield _table(held, columns)

    rows_schema = pa.schema([("doc_id", pa_type(rows)), *_PIECES.items()])
    return in_batches(rows, job, extended(rows, ["doc_id"], _RESULT))


def _table(rows: list[tuple], fields: list[pa.Field]) -> pa.RecordBatch:
    arrays = [pa.array(values, field.type) for values, field in zip(zip(*rows), fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))


def transformed(docs: DataFrame, **options: int) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of each document, the output as text.

    An output has as many bytes as its text, and nine of marks; it is put together where its pieces arrive in order.
    Plain documents' own texts are their outputs and come from ``docs`` by a shuffle-free pass. Options are those of
    ``pieces``.
    """
    seed = options.get("seed", SEED)
    percent, suffix_first = options.get("percent", PERCENT), options.get("suffix_first", SUFFIX_FIRST)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    result = "n long, form string, prefix_chars long, middle_chars long, output string"
    id_type = pa_type(rows)
    fields = [pa.field("doc_id", id_type), *[pa.field(c, _PIECES[c]) for c in columns[1:]], pa.field("output", pa.string())]

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, stream in _documents(batches):
            output = b"".join(stream).decode()
            for _ in range(own["copies"]):
                yield _table([(*[own[name] for name in columns], output)], fields)

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            plain = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch, "text"), strict=True):
                _, _, h3, h4 = drawn(doc_id, seed)
                if form_of(text, h3, h4, percent, suffix_first) == "plain":
                    plain.append((doc_id, len(unit_ends(text)), "plain", None, None, text.decode()))
            if plain:
                yield _table(plain, fields)

    changed = in_order(pieces(docs, seed, percent, suffix_first).filter("form IS NULL OR form <> 'plain'"))
    schema = extended(rows, ["doc_id"], result)
    return in_batches(changed, assemble, schema).unionByName(in_batches(rows, leave, schema))


def fill_in_middle(docs: DataFrame, **options: int) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256 of each row.

    Null texts are empty, and those are plain. A null id draws as the empty text does. Rows that repeat an id and a
    text are returned as often; different texts of one id draw alike and stay apart. Texts may be of any length and
    may be one unit. Other columns are ignored. No rows give none. Options are those of ``pieces``.
    """
    return digested(in_order(restored(in_order(pieces(docs, **options)))))


def oracle() -> str:
    """The same as SQL for DuckDB."""
    hexes = [f"CAST('0x' || h[{8 * k + 1}:{8 * k + 8}] AS BIGINT) AS h{k + 1}" for k in range(4)]
    marks = {name: mark.decode() for name, mark in MARKS.items()}
    marked = " OR ".join(f"contains(text, '{mark}')" for mark in marks.values())

    def output(form: str) -> str:
        return " || ".join(f"'{marks[letter]}' || {letter}" for letter in form)

    return f"""
        WITH d AS (
          SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
          FROM documents
        ),
        cut AS (
          SELECT doc_id, text, {", ".join(hexes)}, regexp_extract_all(text, '[{BLANKS}]*{WORD}|[{BLANKS}]+') AS units FROM d
        ),
        ends AS (
          SELECT *, len(units) AS n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            CASE WHEN text = '' OR {marked} OR h3 % 100 >= {PERCENT} THEN 'plain'
              WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
          FROM cut
        ),
        parts AS (
          SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a + 1:b], ''), '') AS m,
            coalesce(array_to_string(units[b + 1:], ''), '') AS s
          FROM ends
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
          CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
          sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN {output("psm")} ELSE {output("spm")} END) AS output_sha256,
          sha256(CASE form WHEN 'plain' THEN text ELSE p || m || s END) AS restored_sha256
        FROM parts"""
