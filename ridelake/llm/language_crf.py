"""Language of documents and of the words in code-switched text, by a linear-chain CRF.

A word's features are its n-grams with its ends marked (those with an end are its affixes) and the word itself, the
lexicon feature; they are hashed to rows of a weight table. Emissions and transitions are learnt together, on texts
spliced from runs of words of different documents, so that the transitions learn how rarely the language changes.
Words are labelled with their marginal probabilities, by forward-backward over the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm import crf
from ridelake.llm.common import extended, held_out, in_batches, labelled_sample, slices, strings, with_columns

UNKNOWN = "und"
#: Documents of each language the model is fitted on, at most.
PER_LANGUAGE = 300
ROWS = 1 << 16
GRAMS = (2, 3, 4)
#: Words whose scores a task keeps.
KEPT_WORDS = 200_000
_WORD = re.compile(r"[^\W\d_]+")
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the weight table for every word, laid end to end, and where each word's begin."""
    marked = "".join([f"\x02{word}\x03" for word in words])
    code = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    of = np.repeat(np.arange(len(words)), sizes)
    starts = np.cumsum(sizes) - sizes
    found, owner = [], []
    for n in GRAMS:
        count = len(code) - n + 1
        if count <= 0:
            continue
        value = np.full(count, n, dtype=np.uint64)
        for k in range(n):
            value = (value + code[k : count + k]) * _PRIME
            value ^= value >> np.uint64(29)
        inside = of[:count] == of[n - 1 :]
        found.append(value[inside])
        owner.append(of[:count][inside])
    place = np.arange(len(code), dtype=np.uint64) - np.repeat(starts, sizes).astype(np.uint64)
    mixed = (code + place * np.uint64(0x2545F4914F6CDD1D)) * _PRIME
    mixed ^= mixed >> np.uint64(31)
    found.append(np.add.reduceat(mixed * _PRIME, starts))
    owner.append(np.arange(len(words)))
    rows, owner = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    rows = ((rows * _PRIME) >> np.uint64(64 - ROWS.bit_length() + 1)).astype(np.int64)[order]
    return rows, np.searchsorted(owner[order], np.arange(len(words)))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    chain: crf.Chain

    def scores(self, words: list[str]) -> np.ndarray:
        rows, starts = features(words)
        return np.add.reduceat(self.weights[rows], starts, axis=0)


def words_of(text: str) -> list[str]:
    """Runs of letters in small letters; none if there is no letter."""
    words = _WORD.findall(text.lower())
    if words and not any(map(str.isalpha, words)) and not any(map(str.isalpha, "".join(words))):
        return []  # signs such as superscript digits
    return words


def fit(sample: list[tuple[str, str]], epochs: int = 6, length: int = 64, batch: int = 128, seed: int = 7) -> Model:
    """From (language, text); AdaGrad on the likelihood of spliced sequences."""
    rng = np.random.default_rng(seed)
    languages = sorted({language for language, _ in sample})
    runs: list[tuple[int, list[str]]] = []
    for language, text in sample:
        words, at = words_of(text), 0
        while at < len(words):
            size = 4 + int(rng.geometric(1 / 24))
            runs.append((languages.index(language), words[at : at + size]))
            at += size
    types = list(dict.fromkeys(chain.from_iterable(words for _, words in runs)))
    model = Model(languages, np.zeros((ROWS, len(languages))), crf.Chain(np.zeros((len(languages),) * 2), np.zeros(len(languages))))
    if len(languages) < 2 or not types:
        return _shrunk(model)
    index = {word: k for k, word in enumerate(types)}
    rows, starts = features(types)
    ends = np.append(starts[1:], len(rows))
    squares = [np.full(x.shape, 1e-2) for x in (model.weights, model.chain.moves, model.chain.first)]
    for _ in range(epochs):
        order = rng.permutation(len(runs))
        ids = np.array([index[w] for k in order for w in runs[k][1]])
        gold = np.array([runs[k][0] for k in order for _ in runs[k][1]])
        whole = max(len(ids) // length, 1)
        ids, gold = np.resize(ids, (whole, length)), np.resize(gold, (whole, length))
        for at in range(0, whole, batch):
            part, truth = ids[at : at + batch], gold[at : at + batch]
            seen, back = np.unique(part, return_inverse=True)
            sizes = ends[seen] - starts[seen]
            own = rows[np.repeat(starts[seen] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
            firsts = np.cumsum(sizes) - sizes
            scores = np.add.reduceat(model.weights[own], firsts, axis=0)[back.reshape(part.shape)]
            by_score, by_move, by_first = crf.gradient(model.chain, scores, truth)
            by_type = np.zeros((len(seen), len(languages)))
            np.add.at(by_type, back.ravel(), by_score.reshape(-1, len(languages)))
            by_row = np.zeros_like(model.weights)
            np.add.at(by_row, own, np.repeat(by_type, sizes, axis=0))
            for value, step, square in zip(
                (model.weights, model.chain.moves, model.chain.first),
                (by_row / part.size, by_move / part.size, by_first / len(part)),
                squares,
                strict=True,
            ):
                square += step**2
                value += 0.5 * step / np.sqrt(square)
    return _shrunk(model)


def _shrunk(model: Model) -> Model:
    moves, first = model.chain.moves.astype(np.float32), model.chain.first.astype(np.float32)
    return Model(model.languages, model.weights.astype(np.float32), crf.Chain(moves, first))


def fit_documents(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fitted on a bounded sample of the documents that have a language and aren't held out."""
    known = docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", F.col("lang").cast("string").alias("label"))
    return fit(labelled_sample(known, known, per_language))


class Labeller:
    """Labels texts, and keeps the scores of words that came up first."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.index: dict[str, int] = {}
        self.table = np.zeros((0, len(model.languages)), dtype=np.float32)

    def _scores(self, words: list[str]) -> np.ndarray:
        new = list(set(words).difference(self.index))
        index, table = self.index, self.table
        if new:
            more = self.model.scores(new)
            table = np.concatenate([self.table, more])
            added = dict(zip(new, range(len(self.index), len(table)), strict=True))
            if len(table) <= KEPT_WORDS:
                index.update(added)
                self.table = table
            else:
                keys = index.keys() & set(words)
                added.update((word, index[word]) for word in keys)
                index = added
        return table[np.fromiter(map(index.__getitem__, words), np.int64, len(words))]

    def marginals(self, words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Of the words of all texts, laid end to end; and where each text ends."""
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        flat = list(chain.from_iterable(words))
        begins = np.zeros(len(flat), dtype=bool)
        begins[(ends - [len(x) for x in words])[[len(x) > 0 for x in words]]] = True
        return crf.marginals(self.model.chain, self._scores(flat), begins), ends


def _labeller(shared: Broadcast) -> Labeller:
    model = shared.value
    if not hasattr(model, "labeller"):
        model.labeller = Labeller(model)
    return model.labeller


def languages(docs: DataFrame, model: Model, spark: SparkSession) -> DataFrame:
    """(doc_id, lang_pred, score) of every row: the language with the highest mean probability over the words.

    Texts that are null or without a letter are ``und`` with score 0, as are all if no language was learnt. Equal
    probabilities go to the language first by name. Rows that repeat are labelled each, other columns ignored; no
    rows give none. A text is read whole, however long.
    """
    shared = spark.sparkContext.broadcast(model)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = [words_of(text) for text in strings(batch, "text")]
            names, scores = [UNKNOWN] * len(words), np.zeros(len(words))
            if shared.value.languages and any(words):
                found, ends = _labeller(shared).marginals(words)
                some = np.flatnonzero([len(x) > 0 for x in words])
                sizes = np.array([len(words[k]) for k in some])
                means = np.add.reduceat(found.astype(np.float64), ends[some] - sizes, axis=0) / sizes[:, None]
                best = means.argmax(axis=1)
                scores[some] = np.clip(means[np.arange(len(some)), best], 0, 1)
                for k, label in zip(some.tolist(), best.tolist(), strict=True):
                    names[k] = shared.value.languages[label]
            yield with_columns(batch, ["doc_id"], {"lang_pred": pa.array(names), "score": pa.array(scores)})

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return in_batches(rows, job, extended(rows, ["doc_id"], "lang_pred string, score double"))


def language_spans(docs: DataFrame, model: Model, spark: SparkSession) -> DataFrame:
    """(doc_id, start, end, lang): runs of words whose likeliest language is the same, in code points of the text.

    Texts without a letter have none.
    """
    shared = spark.sparkContext.broadcast(model)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = strings(batch, "text")
            matches = [list(re.finditer(_WORD, text)) for text in texts]
            words = [[m[0].lower() for m in found] if words_of(text) else [] for found, text in zip(matches, texts, strict=True)]
            found, ends = _labeller(shared).marginals(words)
            labels, out = found.argmax(axis=1), []
            for row, end in enumerate(ends.tolist()):
                own = labels[end - len(words[row]) : end]
                cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    if a < b:
                        out.append((row, matches[row][a].start(), matches[row][b - 1].end(), shared.value.languages[own[a]]))
            at = pa.array([x[0] for x in out], pa.int64())
            columns = {"start": pa.array([x[1] for x in out], pa.int64()), "end": pa.array([x[2] for x in out], pa.int64())}
            columns["lang"] = pa.array([x[3] for x in out], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), *columns.values()], ["doc_id", *columns])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return in_batches(rows, job, extended(rows, ["doc_id"], "start long, end long, lang string"))
