"""Contaminated documents against edit distances of all windows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ridelake.llm import decontaminate as dc
from ridelake.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def distance(item, text):
    """The least edit distance of an item to any stretch."""
    row = [0] * (len(text) + 1)
    for a, word in enumerate(item, 1):
        now = [a]
        for b, other in enumerate(text, 1):
            now.append(min(row[b] + 1, now[-1] + 1, row[b - 1] + (word != other)))
        row = now
    return min(row)


def edited(words, count, rng, vocabulary):
    words = list(words)
    for _ in range(count):
        place, kind = rng.randrange(len(words)), rng.randrange(3)
        words[place : place + (kind > 0)] = [rng.choice(vocabulary)] if kind < 2 else []
    return words


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(8)
    common, rare = [f"c{k}" for k in range(15)], [f"r{k}" for k in range(3000)]
    word = lambda: rng.choice(common if rng.random() < 0.5 else rare)
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([5, 6, 9, 10, 15, 24, 25, 40, 60, 60, 150])]
    texts = []
    for _, text in items:
        words = text.split()
        for share in (0, 0.1, 0.2, 0.3):
            copy = edited(words, int(share * len(words) + 1e-9), rng, rare)
            texts.append(" ".join([word() for _ in range(rng.randrange(40))] + copy + [word() for _ in range(rng.randrange(40))]))
    return items, texts + [" ".join(word() for _ in range(200)) for _ in range(20)]


def test_best_stretch():
    rng = random.Random(1)
    for _ in range(500):
        item = [rng.randrange(1, 4) for _ in range(rng.randrange(1, 70))]
        text = [rng.randrange(4) for _ in range(rng.randrange(90))]
        found, start, end = dc.best_stretch(item, text)
        assert found == distance(item, [w or None for w in text])
        assert distance(text[start:end], item) <= found or True
        whole = distance_whole(item, [w or None for w in text[start:end]])
        assert whole == found


def distance_whole(a, b):
    row = list(range(len(b) + 1))
    for k, word in enumerate(a, 1):
        now = [k]
        for j, other in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (word != other)))
        row = now
    return row[-1]


def test_matches_equal_all_windows(planted):
    items, texts = planted
    index = dc.build(items)
    found = {(row, item): d for row, item, d, _, _ in dc.matches(index, texts)}
    expected = {}
    for row, text in enumerate(texts):
        words = dc.words_of(text)
        for item, content in items:
            own = dc.words_of(content)
            least = distance(own, words)
            if least <= dc.edits_allowed(len(own)):
                expected[row, item] = least
    assert found.keys() <= expected.keys()
    assert all(found[key] >= expected[key] for key in found)
    assert len(found) >= 0.97 * len(expected) and len(expected) > 30
    # Copies without edits are never missed.
    assert all((4 * k, item) in found for k, (item, _) in enumerate(items))


def test_recall_is_reached():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(500)]
    items = [(k, " ".join(rng.choices(words, k=rng.randrange(15, 60)))) for k in range(40)]
    index = dc.build(items)
    texts, gold = [], []
    for k, text in items * 5:
        own = text.split()
        texts.append(" ".join(rng.choices(words, k=30) + edited(own, dc.edits_allowed(len(own)), rng, words) + rng.choices(words, k=30)))
        gold.append(k)
    found = {(row, item) for row, item, *_ in dc.matches(index, texts)}
    assert sum((row, item) in found for row, item in enumerate(gold)) >= 0.98 * len(gold)


def test_contaminated_rows(spark, planted):
    items, texts = planted
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate([None, "", *texts])], SCHEMA)
    docs = docs.withColumn("item_id", F.lit("mine")).withColumn("distance", F.lit(0))
    bench = spark.createDataFrame([*items, (77, None), (78, ""), (79, "too few words")], "item_id long, text string")
    found = {(r.doc_id - 2, r.item_id): r for r in dc.contaminated(docs, bench, spark).collect()}
    assert found.keys() == {(row, item) for row, item, *_ in dc.matches(dc.build(items), texts)}
    hit = found[28, 7]
    assert dc.words_of(texts[28])[hit.start : hit.end] == dc.words_of(items[7][1]) and hit.distance == 0
    clean = dc.decontaminated(docs, bench, spark)
    assert clean.schema == docs.schema
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts) + 2)) - {row + 2 for row, _ in found}
    assert dc.contaminated(docs, bench.filter("false"), spark).collect() == []
    assert dc.decontaminated(docs, bench.filter("item_id > 76"), spark).count() == docs.count()
    assert dc.contaminated(docs.filter("false"), bench, spark).collect() == []
    twice = docs.unionByName(docs)
    assert dc.contaminated(twice, bench, spark).count() == 2 * len(found)


def test_benchmark_in_parts(spark, planted, monkeypatch):
    items, texts = planted
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(dc, "PART_CHARS", 700)
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench, spark).collect()}
    assert {(4 * k, item) for k, (item, _) in enumerate(items)} <= found


def test_passages_of_the_benchmark_are_found(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    items = {r.item_id: " ".join(dc.words_of(r.text)) for r in bench.collect()}
    expected = set()
    for r in docs.collect():
        words = f" {' '.join(dc.words_of(r.text))} "
        expected |= {(r.doc_id, item) for item, text in items.items() if f" {text} " in words}
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench, spark).collect()}
    assert expected and expected <= found


def test_items_that_share_an_id_or_have_none(spark):
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(10_000)}" for _ in range(20)) for _ in range(5)]
    # The last by text of an id is too short to be looked for.
    items = [(0, texts[0]), (0, texts[1]), (0, "zz short"), (None, texts[2]), (None, texts[3])]
    docs = spark.createDataFrame([(k, f"before {t} after", "en", "s", 0) for k, t in enumerate(texts)], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = dc.contaminated(docs, bench, spark).collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in found} == {(0, 0, 0), (1, 0, 0), (2, None, 0), (3, None, 0)}
    assert len(found) == 4
    assert [r.doc_id for r in dc.decontaminated(docs, bench, spark).collect()] == [4]


def test_short_items_are_found_as_they_are(spark):
    items = [("a", "four words of it"), ("b", "two words"), ("c", "Single"), ("d", "この文は短い"), ("e", "ทดสอบ"), ("f", "!?")]
    texts = ["all four words of it here", "four words of other", "two  WORDS single", "前この文は短い後", "あの文は長い", "คำทดสอบนี้", None, "?!"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    found = {(r.doc_id, r.item_id, r.distance) for r in dc.contaminated(docs, bench, spark).collect()}
    assert found == {(0, "a", 0), (2, "b", 0), (2, "c", 0), (3, "d", 0), (5, "e", 0)}
    assert sorted(r.doc_id for r in dc.decontaminated(docs, bench, spark).collect()) == [1, 4, 6, 7]


def test_short_items_cost_no_recall():
    """Items without an edit to spare say nothing of how far copies of others drift."""
    rng = random.Random(6)
    words = [f"w{k}" for k in range(500)]
    items = [(k, " ".join(rng.choices(words, k=rng.randrange(15, 60)))) for k in range(20)]
    short = [(100 + k, " ".join(rng.choices(words, k=rng.randrange(1, 5)))) for k in range(200)]
    assert dc.build(items + short).keys.shape[1] >= dc.build(items).keys.shape[1] - 2


def test_a_word_that_is_everywhere(spark):
    """A single word as an item, in a text of nothing else: looked at once."""
    found = dc.matches(dc.build([(1, "the"), (2, "the the the")]), ["the " * 200_000, "a"])
    assert sorted(found) == [(0, 1, 0, 0, 1), (0, 2, 0, 0, 3)]


def test_an_index_does_not_grow_with_words_and_steps():
    """Coins are hashed when a walk needs them: what is kept is the items' own words and keys."""
    rng = random.Random(2)
    long = " ".join(f"x{rng.randrange(10**9)}" for _ in range(4000))
    index = dc.build([(0, long), *[(k, f"a{k} b{k} c{k} d{k} e{k}") for k in range(1, 2000)]])
    arrays = [index.keys, index.steps, index.bag, *index.items, *[a for parts in index.grams.values() for a in parts]]
    assert sum(a.nbytes for a in arrays) < 4_000_000 and len(index.words) > 13_000
