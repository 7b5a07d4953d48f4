"""Fill-in-middle against cutting each text whole, and round trips."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ridelake.llm import fill_in_middle as fim

DOCS = "doc_id long, text string"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plainly(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output)"""
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    digits = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digits[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS).withColumn("n", F.lit("mine")).withColumn("piece", F.lit(1))


def check(spark, rows):
    expected = [(doc_id, *plainly(doc_id, text)) for doc_id, text in rows]
    found = Counter(tuple(r) for r in fim.fill_in_middle(frame(spark, rows)).collect())
    assert found == Counter((*row[:5], sha(row[5]), sha(text or "")) for row, (_, text) in zip(expected, rows))
    assert Counter(tuple(r) for r in fim.transformed(frame(spark, rows)).collect()) == Counter(expected)


def odd_texts(rng):
    parts = ["a", "word", " ", "\n", "\t ", "é", "漢字", "<", "<P", "S>", "<M", ">", "\x1c", "　", "😀"]
    return ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(300)]


def test_equals_cutting_whole_texts(spark):
    rng = random.Random(7)
    texts = [*odd_texts(rng), None, "", " ", "a<P>b", "<S>", "x <M>"]
    check(spark, list(enumerate(texts)) + [(None, "no id here at all"), (None, None)])


@pytest.mark.parametrize("size", [1, 5, 64])
def test_any_size_of_pieces(spark, size, monkeypatch):
    rng = random.Random(8)
    rows = list(enumerate(odd_texts(rng)[:80])) + [(1000, "x" * 500 + " y"), (1001, " " * 300), (1002, "漢" * 200)]
    pieces = [row for doc_id, text in rows for row in fim._document(text.encode(), doc_id, 42, 100, 80)]
    monkeypatch.setattr(fim, "PIECE_BYTES", size)
    cut = [row for doc_id, text in rows for row in fim._document(text.encode(), doc_id, 42, 100, 80)]
    assert len(cut) > len(pieces)
    assert max(len(row[3] or b"") for row in cut) <= max(2 * size, 3)
    for doc_id, text in rows:
        own = list(fim._document(text.encode(), doc_id, 42, 100, 80))
        if own[0][4 + 1] == "plain":
            continue
        reader, sections = fim.Reader(own[0][5]), {0: b"", 1: b"", 2: b""}
        for row in own[1:]:
            for section, position, data in reader.read(row[3]):
                assert position == len(sections[section])
                sections[section] += data
        assert b"".join(sections.values()).decode() == text


def test_units_are_whole_in_pieces(monkeypatch):
    monkeypatch.setattr(fim, "PIECE_BYTES", 20)
    text = ("some words of a text " * 20).encode()
    ends = set(fim.unit_ends(text).tolist())
    assert all(end in ends for _, end in fim._cut(0, len(text), fim.unit_ends(text)))


def test_repeated_ids_and_rows(spark):
    same = [(k, f"some text number {k} with more words") for k in range(20)]
    check(spark, same + same + [(k, f"another text {k} of the same id") for k in range(20)] + [(3, None)] * 3)


def test_nothing(spark):
    check(spark, [])


def test_very_long_texts(spark):
    check(spark, [(k, text) for k, text in enumerate(["word " * 400_000, "x" * 2_000_000, " " * 500_000] * 4)])


def test_ids_of_another_type(spark):
    docs = spark.createDataFrame([("a", "one two three four"), (None, "five")], "doc_id string, text string")
    found = {r["doc_id"]: r for r in fim.fill_in_middle(docs).collect()}
    for doc_id, text in (("a", "one two three four"), (None, "five")):
        assert found[doc_id]["output_sha256"] == sha(plainly(doc_id, text)[4])
        assert found[doc_id]["restored_sha256"] == sha(text)
