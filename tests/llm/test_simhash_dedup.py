"""SimHash groups against all pairs, and what odd rows give."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ridelake.llm import simhash_dedup as sd
from ridelake.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def by_definition(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def grouped(prints, limit=3):
    """{id: smallest reachable id} over all pairs."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= limit:
                one, other = find(a), find(b)
                root[max(one, other)] = min(one, other)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize(
    "text", ["", " \n", "One", "one TWO", "É a b c", "a b c d e\x1cf", "x " * 70_000, "the cat sat on the mat " * 9]
)
def test_fingerprint(text):
    assert sd.fingerprint(text.encode()) == by_definition(text)


def test_groups_equal_all_pairs(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(60):
        base = rng.choices(words, k=rng.choice([40, 200, 900]))
        texts.append(base)
        for _ in range(rng.randrange(5)):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
    texts = [" ".join(text) for text in texts] + ["", None, "  ", texts[0] and " ".join(texts[0])]
    rows = [(k, text, "en", "s", 0) for k, text in enumerate(texts)]
    found = {r.doc_id: r for r in sd.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    prints = {k: by_definition(text) for k, text in enumerate(texts)}
    expected = grouped(prints)
    assert {k: r.fingerprint % 2**64 for k, r in found.items()} == prints
    assert {k: r.component_id for k, r in found.items()} == expected
    assert len(set(expected.values())) < len(texts) - 30


@pytest.mark.parametrize("full", [4096, 8])
def test_links_span_what_all_pairs_join(spark, full):
    """Chains and balls of fingerprints; with few to a bucket the buckets are dealt anew."""
    rng = random.Random(9)
    prints = set()
    for _ in range(12):
        value = rng.getrandbits(64)
        for _ in range(rng.choice([1, 5, 60])):
            prints.add(value)
            for bit in rng.sample(range(64), rng.randrange(1, 4)):
                value ^= 1 << bit
    center = rng.getrandbits(64)
    prints |= {center ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)}
    signed = {p - 2**64 if p >> 63 else p: p for p in prints}
    frame = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = {r.node: r.root for r in components(sd.links(frame, full=full)).collect()}
    expected = grouped(signed)
    assert {s: roots.get(s, s) for s in signed} == expected


def test_pairs_beyond_the_limit_are_not_linked():
    rng = np.random.default_rng(2)
    prints = rng.integers(0, 2**64, 50, dtype=np.uint64)
    for change, links in ((0b1111, 0), (0b10101, 50)):
        u, v = sd.linked(np.zeros(100, dtype=np.int64), np.concatenate([prints, prints ^ np.uint64(change)]))
        assert len(u) == len(v) == links
        assert all(int(a) ^ int(b) == change for a, b in zip(u, v, strict=True))


def test_odd_rows(spark):
    rows = [(5, "a b c d", "en", "s", 0), (5, "a b c d", "en", "s", 0), (None, "a b c d", None, None, None), (9, None, None, "x", None), (8, "", None, "x", None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("fingerprint", F.lit("mine")).withColumn("component_id", F.lit(0))
    found = sorted((r.doc_id or 0, r.fingerprint, r.component_id) for r in sd.near_duplicates(docs).collect())
    print_ = sd.fingerprint(b"a b c d")
    signed = print_ - 2**64 if print_ >> 63 else print_
    assert found == [(0, signed, 5), (5, signed, 5), (5, signed, 5), (8, 0, 8), (9, 0, 8)]
    kept = sd.first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(5, "a b c d"), (8, "")]
    empty = docs.filter("false")
    assert sd.near_duplicates(empty).collect() == sd.first_of_each(empty).collect() == []


def test_one_row_of_each_component_stays(spark):
    """Ids that repeat, within components and across them, and ids that are missing."""
    rng = random.Random(21)
    words = "one two three four five six seven eight nine ten".split()
    for round_ in range(3):
        bases = [rng.choices(words, k=60) for _ in range(6)] + [[], ["x"]]
        rows = []
        for _ in range(50):
            text = list(rng.choice(bases))
            if len(text) > 2 and rng.random() < 0.6:
                text[rng.randrange(len(text))] = rng.choice(words)
            text = " ".join(text) if text else rng.choice([None, "", " "])
            rows.append((rng.choice([None, *range(8)]), text, rng.choice(["en", None]), rng.choice("st"), 0))
        rows += rng.choices(rows, k=15)
        prints = {text: by_definition(text) for _, text, *_ in rows}
        component = grouped(dict(zip(prints, prints.values())) and {p: p for p in set(prints.values())})
        docs = spark.createDataFrame(rows, SCHEMA).withColumn("_h", F.lit("mine")).withColumn("_copies", F.lit(3))
        kept = sd.first_of_each(docs)
        assert kept.columns == docs.columns
        found = [tuple(r)[:5] for r in kept.collect()]
        assert set(found) <= set(rows)
        of_component = {}
        for row in rows:
            of_component.setdefault(component[prints[row[1]]], []).append(row)
        assert sorted(component[prints[row[1]]] for row in found) == sorted(of_component)
        for row in found:
            ids = [r[0] for r in of_component[component[prints[row[1]]]] if r[0] is not None]
            assert row[0] == min(ids, default=None)
        again = sd.first_of_each(docs.repartition(round_ + 2))
        assert sorted(map(repr, found)) == sorted(repr(tuple(r)[:5]) for r in again.collect())


def test_components(spark):
    path = [(k, k + 1) for k in range(100)]
    hub = [(1000, k) for k in range(1001, 1200)]
    edges = spark.createDataFrame(path + hub + path + [(7, 7), (None, 3)], "u long, v long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert roots == {**dict.fromkeys(range(101), 0), **dict.fromkeys(range(1000, 1200), 1000)}
    assert components(edges.filter("false")).collect() == []
