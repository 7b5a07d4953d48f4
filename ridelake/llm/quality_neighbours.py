"""Quality of documents by votes of their nearest labelled neighbours in a latent-semantic space.

A document's terms describe how it is written rather than which words it has: trigrams over kinds of characters
(runs of one kind count once), how often words follow themselves or are repeated, and its length. Counts are
damped and weighted by rarity in the sample; a truncated singular value decomposition of the sample gives the latent
directions. The labelled vectors are bounded in number and so are broadcast; every document is compared with all
of them, by exact cosine products in blocks, and its nearest vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm.common import extended, held_out, in_batches, labelled_sample, slices, utf8, with_columns

#: Labelled documents of each label, at most; latent directions; neighbours that vote.
PER_LABEL = 1200
DIRECTIONS = 48
NEIGHBOURS = 15
_BLOCK = 1024

# -- terms ----------------------------------------------------------------------

_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SMALL, CAPITAL, DIGIT, SPACE, LINE = range(5)
KINDS = 6 + len(_SIGNS)
_KIND = np.full(256, SMALL, dtype=np.int32)
_KIND[:33] = _KIND[127] = SPACE
_KIND[10] = LINE
_KIND[48:58], _KIND[65:91] = DIGIT, CAPITAL
_KIND[[ord(c) for c in _SIGNS]] = np.arange(5, 5 + len(_SIGNS))
TRIGRAMS = KINDS**3
#: Terms of other kinds: each has levels, of which one is set.
_LEVELS, _OTHERS = 12, 4
TERMS = TRIGRAMS + _LEVELS * _OTHERS


def _shares(words: list[bytes]) -> list[float]:
    """Of words equal to the one before, different words, words of small letters alone, and the length's logarithm."""
    n = len(words)
    if not n:
        return [0.0, 0.0, 0.0, 0.0]
    again = sum(map(bytes.__eq__, words[1:], words))
    return [again / n, len(set(words)) / n, sum(map(bytes.islower, words)) / n, min(np.log2(1 + n) / 16, 1.0)]


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, weight) of all texts, by text and term: logarithms of counts."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    of = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
    kind = _KIND[data]
    fresh = np.ones(len(kind), dtype=bool)
    fresh[1:] = (kind[1:] != kind[:-1]) | (of[1:] != of[:-1])
    kind, of = kind[fresh], of[fresh]
    gram = (kind[:-2] * KINDS + kind[1:-1]) * KINDS + kind[2:]
    inside = of[:-2] == of[2:]
    shares = np.array([_shares(text.split()) for text in texts]).reshape(-1, _OTHERS)
    level = TRIGRAMS + np.arange(_OTHERS) * _LEVELS + np.minimum(shares * _LEVELS, _LEVELS - 1).astype(np.int64)
    keys, counts = np.unique(of[:-2][inside].astype(np.int64) * TERMS + gram[inside], return_counts=True)
    row, term = np.divmod(keys, TERMS)
    weight = np.log1p(counts)
    # The levels weigh as much as half the trigrams.
    norm = np.sqrt(np.bincount(row, weight**2, len(texts)) / 2) + 1e-9
    row = np.concatenate([row, np.repeat(np.arange(len(texts)), _OTHERS)])
    term = np.concatenate([term, level.ravel()])
    weight = np.concatenate([weight, np.repeat(norm / np.sqrt(_OTHERS), _OTHERS)])
    return row, term, weight


def terms_in_parts(texts: list[bytes], most_bytes: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same, with the memory that about ``most_bytes`` of text need."""
    found, start, held = [], 0, 0
    for k, text in enumerate([*texts, b""]):
        if k > start and (k == len(texts) or held + len(text) > most_bytes):
            row, term, weight = terms(texts[start:k])
            found.append((row + start, term, weight))
            start, held = k, 0
        held += len(text)
    return tuple(map(np.concatenate, zip(*found, strict=True)))


# -- the model --------------------------------------------------------------------


@dataclass
class Model:
    """``place``: of each term among those kept, -1 if not; ``vectors``: of the labelled documents, of length one."""

    place: np.ndarray
    rarity: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def latent(self, texts: list[bytes]) -> np.ndarray:
        row, term, weight = terms_in_parts(texts)
        at = self.place[term]
        row, at, weight = row[at >= 0], at[at >= 0], weight[at >= 0]
        out = np.zeros((len(texts), self.directions.shape[1]), dtype=np.float32)
        if len(row):
            order = np.argsort(row, kind="stable")
            row, at, weight = row[order], at[order], weight[order]
            starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            values = self.directions[at] * (weight * self.rarity[at]).astype(np.float32)[:, None]
            out[row[starts]] = np.add.reduceat(values, starts, axis=0)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def scores(self, texts: list[bytes], neighbours: int = NEIGHBOURS) -> np.ndarray:
        """The similarity-weighted share of label 1 among the nearest; one half without any."""
        found = np.full(len(texts), 0.5)
        most = min(neighbours, len(self.labels))
        for start in range(0, len(texts) if most else 0, _BLOCK):
            near = self.latent(texts[start : start + _BLOCK]) @ self.vectors.T
            best = np.argpartition(-near, most - 1, axis=1)[:, :most]
            weight = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype(np.float64) ** 4
            total = weight.sum(axis=1)
            vote = (weight * self.labels[best]).sum(axis=1) / np.maximum(total, 1e-12)
            found[start : start + _BLOCK] = np.where(total > 1e-9, vote, 0.5)
        return np.clip(found, 0, 1)


def fit(sample: list[tuple[int, str]], directions: int = DIRECTIONS, seed: int = 5) -> Model:
    """From (label, text)."""
    texts, labels = [text.encode() for _, text in sample], np.array([label for label, _ in sample], dtype=np.float64)
    place = np.full(TERMS, -1)
    if not texts:
        return Model(place, np.zeros(0), np.zeros((0, 1), np.float32), np.zeros((0, 1), np.float32), labels)
    row, term, weight = terms_in_parts(texts)
    documents = np.bincount(term, minlength=TERMS)
    kept = np.flatnonzero(documents >= min(3, len(texts)))
    place[kept] = np.arange(len(kept))
    rarity = 1 + np.log((1 + len(texts)) / (1 + documents[kept]))
    matrix = np.zeros((len(texts), len(kept)), dtype=np.float32)
    known = place[term] >= 0
    matrix[row[known], place[term[known]]] = weight[known] * rarity[place[term[known]]]
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    # Subspace iteration: the leading right singular vectors.
    basis = np.random.default_rng(seed).normal(size=(len(kept), min(directions, *matrix.shape))).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    model = Model(place, rarity, basis, np.zeros((0, basis.shape[1]), np.float32), labels)
    model.vectors = model.latent(texts)
    return model


def fit_labels(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Fitted on a bounded sample of the labelled documents that aren't held out."""
    learnt = labels.filter(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").cast("int").alias("label"))
    return fit(labelled_sample(docs.select("doc_id", F.col("text").cast("string").alias("text")), learnt, per_label))


def _job(shared, keep):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield with_columns(batch, keep, {"score": pa.array(shared.value.scores(utf8(batch, "text")))})

    return job


def quality_scores(docs: DataFrame, model: Model, spark: SparkSession) -> DataFrame:
    """(doc_id, score) of every row, from 0 to 1; higher: label 1 is likelier.

    Null texts are scored as empty ones. A document like no labelled one, or any if there are no labels, gets one
    half. Of neighbours equally near at the edge of the vote any may vote. Rows that repeat are scored each; other columns
    are ignored; no rows give none. Texts are read whole.
    """
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return in_batches(rows, _job(shared, ["doc_id"]), extended(rows, ["doc_id"], "score double"))


def accepted(docs: DataFrame, model: Model, spark: SparkSession, least: float = 0.3) -> DataFrame:
    """The documents with at least that score, with all their columns."""
    shared = spark.sparkContext.broadcast(model)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(shared.value.scores(utf8(batch, "text")) >= least))

    return in_batches(docs, job, docs.schema)
