"""Benchmark decontamination: item-sized windows of documents within an edit distance of benchmark items.

Texts are words (runs of letters and digits, in small letters; in scripts without spaces each character is one). A window is a match if the edit distance of its
words to an item's is at most a share of the item's. Matches are looked for by locality-sensitive hashing:

* CGK embedding: a random walk reads a window, at each step giving the word under a pointer that moves on or stays
  by a random bit that depends on the step and the word. Windows a small edit distance apart fall into step again
  soon after an edit, so their embeddings have a small Hamming distance.
* Bit sampling: a table's key is what a walk gives at a few steps drawn at random; windows with an item's key are
  candidates. Edited copies of items tell how often a step agrees at the greatest distance allowed, and so how
  many tables, each with a walk and steps of its own, find all but ``1 - recall`` of such windows.
* Candidates are verified by the exact edit distance of the item to the best stretch around the window.

Most windows are never embedded, by two bounds that lose none: ``d`` edits leave some run of an item's words whole,
of at least a ``d + 1``-th of the words that stay, so a window must hold one of the item's n-grams near its place;
and it must hold as many of the item's words as edits leave.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ridelake.llm.common import extended, in_batches, slices, strings

#: Edits allowed for each word of an item.
EDITS = 0.2
RECALL = 0.99
#: Steps whose words make a table's key.
SAMPLED = 2
#: Items are broadcast in parts of this many characters; each counts some more for its keys and numbers. An index takes
#: some 30 bytes of each: a different word about 200, an item's keys 8 for each table.
PART_CHARS, ITEM_CHARS = 8_000_000, 64
#: Scripts written without spaces: Thai, Lao, Burmese, Khmer, kana and Han characters.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_SINGLE = re.compile(f"[{_UNSPACED}]")
_WORD, _MIXED = re.compile(r"\w+"), re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+")
_PAD = 0
_ROWS = 200_000


def words_of(text: str) -> list[str]:
    mixed = not text.isascii() and _SINGLE.search(text)
    return (_MIXED if mixed else _WORD).findall(text.lower())


def edits_allowed(n_words: int, share: float = EDITS) -> int:
    return int(share * n_words + 1e-9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _coin(walk: np.ndarray, symbol: np.ndarray, step: int) -> np.ndarray:
    """The random bit of a walk for a word at a step, a hash of the three: nothing is kept of it."""
    walks = walk.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64((step + 1) * 0xA0761D6478BD642F % 2**64)
    return (_mixed(symbol.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + walks) >> np.uint64(40)).astype(np.int64) & 1


def embedded(
    ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, walk: np.ndarray, sampled: np.ndarray
) -> np.ndarray:
    """The keys of windows: what each one's walk gives at the sampled steps, hashed.

    ``starts`` and ``ends`` are places in ``ids``; ``walk`` is the walk each row takes, ``sampled`` its steps in order.
    """
    at, key = starts.copy(), walk.astype(np.uint64) + np.uint64(1)
    for step in range(int(sampled.max(initial=-1)) + 1):
        inside = at < ends
        symbol = np.where(inside, ids[np.minimum(at, len(ids) - 1)], _PAD)
        taken = (sampled == step).any(axis=1)
        key[taken] = _mixed(key[taken] * np.uint64(0x9E3779B97F4A7C15) + symbol[taken].astype(np.uint64))
        at += _coin(walk, symbol, step)
    return key


@dataclass
class Index:
    """Items as numbers of words; the tables' steps for each, and their keys, (item, table).

    ``grams``: for each length of gram, sorted keys with the item and the place of each; ``bag``: sorted keys of the
    words of each item.
    """

    ids: list
    words: dict[str, int]
    items: list[np.ndarray]
    edits: np.ndarray
    sizes: np.ndarray
    band: np.ndarray
    steps: np.ndarray
    keys: np.ndarray
    grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    bag: np.ndarray


def _grams(ids: np.ndarray, size: int, base: int) -> np.ndarray:
    """The n-gram that begins at each place as a number; 0 where a word belongs to no item."""
    count = max(len(ids) - size + 1, 0)
    key, whole = np.zeros(count, dtype=np.int64), np.ones(count, dtype=bool)
    for k in range(size):
        key = key * base + ids[k : count + k]
        whole &= ids[k : count + k] > 0
    return np.where(whole, key, 0)


def _agreement(items: list[np.ndarray], share: float, symbols: int, rng: np.random.Generator) -> float:
    """How often a step of a walk gives the same word for an item and a copy with the most edits allowed."""
    copies, same, total = [], 0, 0
    items = [item for item in items if edits_allowed(len(item), share)]
    for k in rng.permutation(len(items))[:64].tolist():
        copy = items[k].tolist()
        for _ in range(edits_allowed(len(copy), share)):
            place, kind = int(rng.integers(len(copy))), int(rng.integers(3))
            copy[place : place + (kind > 0)] = [int(rng.integers(1, symbols))] if kind < 2 else []
        copies.append((items[k], np.array(copy, dtype=np.int64)))
    for pair in copies:
        walks = [np.arange(100, 108)] * 2
        at = [np.zeros(8, dtype=np.int64), np.zeros(8, dtype=np.int64)]
        for step in range(2 * len(pair[0])):
            met = [np.where(a < len(w), w[np.minimum(a, len(w) - 1)] if len(w) else _PAD, _PAD) for a, w in zip(at, pair)]
            same, total = same + int((met[0] == met[1]).sum()), total + 8
            at = [a + _coin(walk, symbol, step) for a, walk, symbol in zip(at, walks, met)]
    return same / total if total else 1.0


def build(items: list[tuple[object, str]], share: float = EDITS, recall: float = RECALL, seed: int = 3) -> Index | None:
    """An index of (item_id, text), each for itself if ids repeat; None if no item has a word."""
    texts = [(item, words_of(text or "")) for item, text in items]
    texts = [(item, words) for item, words in texts if words]
    if not texts:
        return None
    rng = np.random.default_rng(seed)
    words = {word: k for k, word in enumerate(dict.fromkeys(chain.from_iterable(found for _, found in texts)), 1)}
    base = len(words) + 1
    coded = [np.array([words[w] for w in found]) for _, found in texts]
    sizes = np.array([len(item) for item in coded])
    edits = np.array([edits_allowed(n, share) for n in sizes.tolist()])
    agree = max(_agreement(coded, share, base, rng), 0.05)
    tables = max(4, int(np.ceil(np.log(1 - recall) / np.log(max(1 - agree**SAMPLED, 1e-9)))))
    # Items of about one length sample the same steps, none beyond those that the shortest of them has words for.
    _, band = np.unique((np.log(sizes) / 0.1).astype(np.int64), return_inverse=True)
    steps = np.zeros((band.max() + 1, tables, SAMPLED), dtype=np.int64)
    for k in range(len(steps)):
        last = 2 * int(sizes[band == k].min())
        steps[k] = [np.sort(rng.choice(last, SAMPLED, replace=False)) for _ in range(tables)]
    flat, ends = np.concatenate(coded), np.cumsum(sizes)
    item, walk = np.repeat(np.arange(len(coded)), tables), np.tile(np.arange(tables), len(coded))
    keys = embedded(flat, (ends - sizes)[item], ends[item], walk, steps[band[item], walk])
    # (n - d) words that stay in at most d + 1 runs; three words are rare enough.
    length = np.clip((sizes - edits + edits) // (edits + 1), 1, 3)
    grams = {}
    for size in np.unique(length).tolist():
        own = [(_grams(coded[k], size, base), k) for k in np.flatnonzero(length == size).tolist()]
        key = np.concatenate([found for found, _ in own])
        of = np.repeat([k for _, k in own], [len(found) for found, _ in own])
        place = np.concatenate([np.arange(len(found)) for found, _ in own])
        order = np.argsort(key, kind="stable")
        grams[size] = (key[order], of[order], place[order])
    bag = np.unique(np.repeat(np.arange(len(coded)), sizes) * base + flat)
    return Index([item for item, _ in texts], words, coded, edits, sizes, band, steps, keys.reshape(-1, tables), grams, bag)


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows and numbers of all whole numbers from low to high, the end excluded, of each row."""
    sizes = np.maximum(high - low, 0)
    rows = np.repeat(np.arange(len(low)), sizes)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[rows]


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different rows, sorted by the first column, then the next."""
    order = np.lexsort(columns[::-1])
    columns = tuple(column[order] for column in columns)
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = np.any([column[1:] != column[:-1] for column in columns], axis=0)
    return tuple(column[fresh] for column in columns)


def _seeded(index: Index, ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, item, place) such that the item may begin at about the place, by its n-grams."""
    base, found = len(index.words) + 1, []
    for size, (keys, items, places) in index.grams.items():
        key = _grams(ids, size, base)
        at = np.flatnonzero(key)
        at = at[text[at] == text[at + size - 1]]
        low, high = (np.searchsorted(keys, key[at], side) for side in ("left", "right"))
        rows, hits = _ranges(low, high)
        found.append((text[at[rows]], items[hits], at[rows] - places[hits]))
    return _distinct(*map(np.concatenate, zip(*found, strict=True)))


def _holding(index: Index, ids: np.ndarray, first: np.ndarray, last: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Whether stretches hold as many words of an item as edits leave."""
    base, enough = len(index.words) + 1, np.zeros(len(item), dtype=bool)
    for at in range(0, len(item), _ROWS):
        part = slice(at, at + _ROWS)
        rows, places = _ranges(first[part], last[part])
        key = item[part][rows] * base + ids[places]
        hit = index.bag[np.minimum(np.searchsorted(index.bag, key), len(index.bag) - 1)] == key
        held = np.bincount(rows, hit, len(item[part]))
        enough[part] = held >= (index.sizes - index.edits)[item[part]]
    return enough


def candidates(
    index: Index, ids: np.ndarray, firsts: np.ndarray, ends: np.ndarray, text: np.ndarray
) -> tuple[np.ndarray, ...]:
    """(text, item, place) of the windows with a key of the item; ``firsts``, ``ends``: of each text's places."""
    own, item, about = _seeded(index, ids, text)
    edits, size, tables = index.edits[item], index.sizes[item], index.keys.shape[1]
    low, high = np.maximum(about - edits, firsts[own]), np.minimum(about + size + edits, ends[own])
    some = np.flatnonzero(_holding(index, ids, low, high, item))
    rows, places = _ranges(low[some], np.minimum(about + edits + 1, ends[own])[some])
    own, item, place = _distinct(own[some][rows], item[some][rows], places)
    same = np.zeros(len(place), dtype=bool)
    for at in range(0, len(place), max(_ROWS // tables, 1)):
        part = slice(at, at + max(_ROWS // tables, 1))
        k, start = item[part], np.repeat(place[part], tables)
        last = np.minimum(place[part] + index.sizes[k], ends[own[part]])
        walk = np.tile(np.arange(tables), len(k))
        steps = index.steps[np.repeat(index.band[k], tables), walk]
        keys = embedded(ids, start, np.repeat(last, tables), walk, steps)
        same[part] = (keys.reshape(-1, tables) == index.keys[k]).any(axis=1)
    return own[same], item[same], place[same]


def best_stretch(item: list[int], text: list[int]) -> tuple[int, int, int]:
    """(distance, start, end) of the stretch of a text nearest to an item, by Myers' bit vectors; the first of equals."""

    def ends(pattern: list[int], words: list[int], anchored: bool) -> tuple[int, int]:
        places: dict[int, int] = {}
        for k, word in enumerate(pattern):
            places[word] = places.get(word, 0) | 1 << k
        top, full = 1 << (len(pattern) - 1), (1 << len(pattern)) - 1
        plus, minus, score = full, 0, len(pattern)
        best = (score, 0)
        for k, word in enumerate(words, 1):
            match = places.get(word, 0) if word else 0
            diagonal = (((match & plus) + plus) ^ plus) | match | minus
            up, down = minus | ~(diagonal | plus) & full, plus & diagonal
            score += (up & top > 0) - (down & top > 0)
            up = up << 1 & full | anchored
            plus = (down << 1 & full) | ~(match | minus | up) & full
            minus = up & (match | minus)
            best = min(best, (score, k))
        return best

    distance, end = ends(item, text, anchored=False)
    _, back = ends(item[::-1], text[:end][::-1], anchored=True)
    return distance, end - back, end


def matches(index: Index, texts: list[str]) -> list[tuple[int, object, int, int, int]]:
    """(text, item_id, distance, start, end) for each text and item that match, in words; the nearest stretch."""
    words = [words_of(text) for text in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total = int(sizes.sum())
    ids = np.fromiter(map(index.words.get, chain.from_iterable(words), repeat(0)), np.int64, total)
    last = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)
    if not total:
        return []
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    done = (-1, -1, -1)
    firsts = last - sizes
    for row, k, place in zip(*(column.tolist() for column in candidates(index, ids, firsts, last, text)), strict=True):
        item, allowed = index.items[k], int(index.edits[k])
        if (row, k) in found and found[row, k][0] == 0:
            continue  # the first of the nearest
        if done[:2] == (row, k) and place + len(item) <= done[2]:
            continue
        first, end = int(firsts[row]), int(last[row])
        low, high = max(first, place - allowed), min(end, place + 2 * len(item) + 2 * allowed)
        done = (row, k, high - allowed)
        distance, a, b = best_stretch(item.tolist(), ids[low:high].tolist())
        if distance <= allowed:
            hit = (distance, low + a - first, low + b - first)
            found[row, k] = min(found.get((row, k), hit), hit)
    return [(row, index.ids[k], *hit) for (row, k), hit in found.items()]


def _indexes(benchmark: DataFrame, share: float, recall: float) -> Iterator[Index]:
    """Of the benchmark, in parts of a bounded size."""
    items = benchmark.filter("text IS NOT NULL").select("item_id", F.col("text").cast("string").alias("text"))
    parts = (items.agg(F.sum(F.length("text") + ITEM_CHARS)).first()[0] or 0) // PART_CHARS + 1
    for part in range(parts):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        if (index := build([(r[0], r[1]) for r in own.distinct().orderBy("item_id", "text").collect()], share, recall)) is not None:
            yield index


def contaminated(
    docs: DataFrame, benchmark: DataFrame, spark: SparkSession, share: float = EDITS, recall: float = RECALL
) -> DataFrame:
    """(doc_id, item_id, distance, start, end) for each row of ``docs`` and item that match, nearest stretch first.

    Distances and places are in words. Null and empty texts match nothing, nor do items without a word; items of under
    five words have no edit to spare, so they are found as they are, in any text that has them: leave out those that
    say nothing (an answer "yes") before. ``item_id`` may be of any type; of equally near stretches the first counts; of items that share an id each counts. Rows
    that repeat are reported each; other columns are ignored. Without items or documents there are no rows.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = benchmark.schema["item_id"].dataType
    schema = extended(rows, ["doc_id"], f"item_id {id_type.simpleString()}, distance long, start long, end long")
    arrow = [pa.int64(), to_arrow_type(id_type), *[pa.int64()] * 3]
    found = spark.createDataFrame([], schema)
    for index in _indexes(benchmark, share, recall):
        shared = spark.sparkContext.broadcast(index)

        def job(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", 8 << 20):
                hits = matches(shared.value, strings(batch, "text"))
                columns = [pa.array([hit[k] for hit in hits], kind) for k, kind in enumerate(arrow)]
                names = ["doc_id", "item_id", "distance", "start", "end"]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(columns[0]), *columns[1:]], names)

        found = found.unionByName(in_batches(rows, job, schema))
    return found


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, spark: SparkSession, share: float = EDITS, recall: float = RECALL
) -> DataFrame:
    """The documents that match no item, with all their columns."""
    kept = docs
    for index in _indexes(benchmark, share, recall):
        shared = spark.sparkContext.broadcast(index)

        def job(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", 8 << 20):
                hit = {row for row, *_ in matches(shared.value, strings(batch, "text"))}
                yield batch.filter(pa.array([row not in hit for row in range(batch.num_rows)], pa.bool_()))

        kept = in_batches(kept, job, docs.schema)
    return kept
