"""Secrets in text: fixed patterns, and a linear-chain CRF that tags tokens as begin, inside or outside of a secret.

The patterns find what has a known form. The field is fitted on a bounded sample in which the patterns mark the
secrets; it sees a token's shape (length, kinds of characters, how they alternate), words about secrets among its
neighbours, and how much a file looks like settings, and so tags values behind other names too. Tags are those of
the best path (Viterbi). A path leaves "outside" only around tokens that are worth it: a bound on what any run of
tokens can gain shows which tokens are outside on a best path, and the path is computed between those.
"""

from __future__ import annotations

import hashlib
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
from ridelake.llm.common import extended, in_batches, labelled_sample, slices, strings, with_columns

#: The kinds of secret and their patterns, in this order, and the least characters.
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: The kind of spans that only the field finds.
TAGGED = "tagged"

OUTSIDE, BEGIN, INSIDE = range(3)
PER_CLASS = 800
KEPT_TOKENS = 150_000
_TOKEN = re.compile(r"[\w+/\-]+(?:\.[\w+/\-]+)*|[^\w\s]")
_ABOUT = re.compile(r"passw|passphrase|pwd|secret|token|api.?key|auth|bearer|credential|private|access.?key", re.I)
_AKIA = re.compile(r"(?m)^AKIA")
_FORBIDDEN = -1e4


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of the value) of what the patterns match, by start and then kind, in code points."""
    found = []
    low = text.lower()
    if any(name in low for name in NAMES):
        found += [
            (m.start(), m.end(), "assign", m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]
        ]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), m.end(), "hex", m.start()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[2])))


# -- features -----------------------------------------------------------------

_FLAGS = ("digit", "small", "capital", "both cases", "hex", "sign", "about", "assigns", "quote", "access", "wide")
_LENGTHS = (1, 2, 4, 6, 8, 12, 16, 20, 24, 32, 64)
_TURNS = (2, 4, 8)
OWN = len(_FLAGS) + len(_LENGTHS) + len(_TURNS) + 2
BESIDE = ("about", "assigns", "quote")
FILE = 4


def _kinds(characters: str, wide: bool = False) -> np.ndarray:
    """A table of which code points below 128 are among some, and whether those from 128 are."""
    return np.array([chr(c) in characters for c in range(128)] + [wide])


_DIGITS, _SMALL, _CAPITAL = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGIT, _IS_SMALL, _IS_CAPITAL = _kinds(_DIGITS), _kinds(_SMALL, wide=True), _kinds(_CAPITAL)
_IS_HEX, _PLAIN, _WIDE = _kinds(_DIGITS + "abcdef"), _kinds(_DIGITS + _SMALL + _CAPITAL, wide=True), _kinds("", wide=True)


def _features(tokens: list[str]) -> np.ndarray:
    """What each token looks like, as zeros and ones."""
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    starts = np.cumsum(sizes) - sizes
    joined = "\n".join(tokens)
    lines = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    code = np.minimum(lines[np.repeat(np.arange(len(tokens)), sizes) + np.arange(sizes.sum())], 128)

    def count(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, starts, dtype=np.int64)

    def has(pattern: re.Pattern) -> np.ndarray:
        found = np.zeros(len(tokens), dtype=bool)
        at = [m.start() for m in pattern.finditer(joined)]
        found[np.searchsorted(starts + np.arange(len(tokens)), at, side="right") - 1] = True
        return found

    digit, plain = _DIGIT[code], _PLAIN[code]
    digits, small, capitals = count(digit), count(_IS_SMALL[code]), count(_IS_CAPITAL[code])
    turn = np.zeros(len(code), dtype=bool)
    turn[1:] = (digit[1:] != digit[:-1]) & plain[1:] & plain[:-1]
    turn[starts] = False
    turns, letters = count(turn), count(plain)
    single = np.where(sizes == 1, code[starts], 0)
    title = (capitals == 1) & _IS_CAPITAL[code[starts]]
    columns = [
        digits > 0,
        small > 0,
        capitals > 0,
        (small > 0) & (capitals > 0) & ~title,
        (sizes >= 8) & (count(_IS_HEX[code]) == sizes) & (digits > 0),
        (sizes > 1) & (letters < sizes),
        has(_ABOUT),
        np.isin(single, [ord(c) for c in "=:"]),
        np.isin(single, [ord(c) for c in "\"'"]),
        has(_AKIA),
        count(_WIDE[code]) > 0,
        *[sizes >= n for n in _LENGTHS],
        *[turns >= n for n in _TURNS],
        (digits > 0) & (digits < letters),
        4 * digits >= letters,
    ]
    return np.stack(columns, axis=1).astype(np.float32)


_BESIDE = [_FLAGS.index(name) for name in BESIDE]


def _file_features(tokens: list[str]) -> list[float]:
    """Of a whole text: how much of it are assignments, quotes, braces and signs of other kinds."""
    n = max(len(tokens), 1)
    assigns = tokens.count("=") + tokens.count(":")
    quotes = tokens.count('"') + tokens.count("'")
    braces = tokens.count("{") + tokens.count("}") + tokens.count(";")
    return [float(assigns > 0), float(20 * assigns > n), float(quotes > 0), float(20 * braces > n)]


WIDTH = OWN + 3 * len(BESIDE) + FILE + 1


@dataclass
class Model:
    weights: np.ndarray
    chain: crf.Chain

    def tables(self, features: np.ndarray) -> np.ndarray:
        """For each kind of token what it adds to its own score and, 3 columns each, to those beside it."""
        parts, at = [features @ self.weights[:OWN]], OWN
        for _ in range(3):
            parts.append(features[:, _BESIDE] @ self.weights[at : at + len(BESIDE)])
            at += len(BESIDE)
        return np.concatenate(parts, axis=1)

    def scores(self, tables: np.ndarray, files: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Of tokens laid end to end: those one and two before, and one after, count within the same text."""
        scores = tables[:, :3] + files[text] @ self.weights[OWN + 9 : OWN + 9 + FILE] + self.weights[-1]
        for offset, column in ((1, 3), (2, 6)):
            same = text[offset:] == text[:-offset]
            scores[offset:] += tables[:-offset, column : column + 3] * same[:, None]
        scores[:-1] += tables[1:, 9:12] * (text[1:] == text[:-1])[:, None]
        return scores


def _design(tokens: list[str]) -> np.ndarray:
    """The features of every token of one text, as rows for the weights."""
    own = _features(tokens)
    beside = own[:, _BESIDE]
    zero = np.zeros_like(beside)
    one, two, after = zero.copy(), zero.copy(), zero.copy()
    one[1:], two[2:], after[:-1] = beside[:-1], beside[:-2], beside[1:]
    file = np.tile(np.array(_file_features(tokens), dtype=np.float32), (len(tokens), 1))
    return np.concatenate([own, one, two, after, file, np.ones((len(tokens), 1), dtype=np.float32)], axis=1)


def _tagged(text: str, values: list[tuple[int, int]]) -> tuple[list[str], np.ndarray]:
    """The tokens of a text, and their labels if the secrets are at these places."""
    matches = list(_TOKEN.finditer(text))
    starts, ends = (np.array([getattr(m, name)() for m in matches], dtype=np.int64) for name in ("start", "end"))
    labels = np.zeros(len(matches), dtype=np.int64)
    for start, end in values:
        own = np.flatnonzero((ends > start) & (starts < end))
        labels[own] = INSIDE
        labels[own[:1]] = BEGIN
    return [m[0] for m in matches], labels


#: Other words that stand before secrets, for the copies of sample texts that the field is fitted on.
_OTHER_NAMES = ("pwd", "passphrase", "auth", "bearer", "credentials", "private_key", "client_secret", "access_key")


def _varied(text: str, rng: np.random.Generator) -> tuple[str, list[tuple[int, int]]]:
    """A text with other names and values in its assignments, and where the values are."""
    letters = _DIGITS + _SMALL + _CAPITAL
    parts, values, at, length = [], [], 0, 0
    for m in ASSIGN.finditer(text):
        if len(m[2]) < LEAST["assign"]:
            continue
        name = _OTHER_NAMES[rng.integers(len(_OTHER_NAMES))]
        value = "".join(letters[k] for k in rng.integers(0, len(letters), int(rng.integers(10, 44))))
        parts += [text[at : m.start()], name, text[m.end(1) : m.start(2)], value]
        length += m.start() - at + len(name) + m.start(2) - m.end(1)
        values.append((length, length + len(value)))
        length, at = length + len(value), m.end()
    return "".join([*parts, text[at:]]), values


def fit(texts: list[str], around: int = 32, steps: int = 300) -> Model:
    """AdaGrad on windows around the secrets, and one elsewhere in each text.

    Texts with assignments are seen again with other names and values, so that the field learns more than the patterns.
    """
    designs, labels, rng = [], [], np.random.default_rng(11)
    marked = [(text, [(value, end) for _, end, _, value in base_spans(text)]) for text in texts]
    marked += [_varied(text, rng) for text, values in marked if values for _ in range(2)]
    for text, values in marked:
        tokens, gold = _tagged(text, values)
        if len(tokens) < around:
            continue
        marks = np.flatnonzero(gold == BEGIN)
        starts = {min(max(int(m) - around // 2, 0), len(tokens) - around) for m in marks} | {len(text) % (len(tokens) - around + 1)}
        rows = _design(tokens)
        for start in sorted(starts):
            designs.append(rows[start : start + around].copy())
            labels.append(gold[start : start + around])
    weights, chain = np.zeros((WIDTH, 3)), crf.Chain(np.zeros((3, 3)), np.zeros(3))
    chain.moves[OUTSIDE, INSIDE] = chain.first[INSIDE] = _FORBIDDEN
    if designs:
        x, gold = np.stack(designs).astype(np.float64), np.stack(labels)
        gold[:, 0] = np.where(gold[:, 0] == INSIDE, BEGIN, gold[:, 0])  # the window cuts a secret
        squares = [np.full(value.shape, 1e-6) for value in (weights, chain.moves, chain.first)]
        for _ in range(steps):
            part = rng.integers(0, len(x), 128)
            by_score, by_move, by_first = crf.gradient(chain, x[part] @ weights, gold[part])
            by_weight = np.einsum("ntf,ntl->fl", x[part], by_score) / part.size - 1e-4 * weights
            for value, step, square in zip(
                (weights, chain.moves, chain.first), (by_weight, by_move / part.size, by_first / part.size), squares, strict=True
            ):
                square += step**2
                value += 0.2 * step / np.sqrt(square)
            chain.moves[OUTSIDE, INSIDE] = chain.first[INSIDE] = _FORBIDDEN
    else:
        weights[-1, OUTSIDE] = 1.0
    return Model(weights.astype(np.float32), crf.Chain(chain.moves.astype(np.float32), chain.first.astype(np.float32)))


def fit_documents(docs: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fitted on a bounded sample of documents: with a word about secrets, and without."""
    low = F.lower(F.col("text"))
    about = F.contains(F.col("text"), F.lit("AKIA"))
    for name in NAMES:
        about = about | F.contains(low, F.lit(name))
    rows = docs.select("doc_id", "text", about.alias("label"))
    return fit([text for _, text in labelled_sample(rows, rows, per_class)])


# -- tagging ------------------------------------------------------------------


def worth_looking(chain: crf.Chain, scores: np.ndarray) -> np.ndarray:
    """The tokens that a best path may leave "outside" for.

    A run of tokens outside "outside" gains at most the sum of the bounds of its tokens; a token can be in a run
    that doesn't lose only if the best such sum through it isn't negative.
    """
    enter = max((chain.moves[:, 1:] - chain.moves[OUTSIDE, OUTSIDE]).max(), (chain.first[1:] - chain.first[OUTSIDE]).max())
    leave = max(0.0, (chain.moves[1:, OUTSIDE] - chain.moves[OUTSIDE, OUTSIDE]).max())
    # Twice rounding apart from the path's own sums.
    bound = scores[:, 1:].max(axis=1).astype(np.float64) - scores[:, OUTSIDE] + max(0.0, enter) + leave + 1e-3
    total = np.concatenate([[0.0], np.cumsum(bound)])
    before = total[:-1] - np.minimum.accumulate(total[:-1])
    after = np.maximum.accumulate(total[::-1])[::-1][1:] - total[1:]
    return before + after + bound >= 0


def tags(model: Model, scores: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The best path's labels of tokens laid end to end."""
    near = worth_looking(model.chain, scores)
    labels = np.zeros(len(scores), dtype=np.int8)
    if not near.any():
        return labels
    wide = near.copy()
    wide[1:] |= near[:-1]
    wide[:-1] |= near[1:]
    at = np.flatnonzero(wide)
    own = scores[at].copy()
    own[~near[at], 1:] = _FORBIDDEN
    apart = begins[at] | np.append(True, np.diff(at) > 1)
    labels[at] = crf.best_labels(model.chain, own, apart)
    return labels


class Tagger:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.index: dict[str, int] = {}
        self.table = np.zeros((0, 12), dtype=np.float32)

    def _tables(self, tokens: list[str]) -> np.ndarray:
        new = list(set(tokens).difference(self.index))
        index, table = self.index, self.table
        if new:
            table = np.concatenate([table, self.model.tables(_features(new))])
            added = dict(zip(new, range(len(index), len(table)), strict=True))
            if len(table) <= KEPT_TOKENS:
                index.update(added)
                self.table = table
            else:
                index = added | {token: index[token] for token in index.keys() & set(tokens)}
        return table[np.fromiter(map(index.__getitem__, tokens), np.int64, len(tokens))]

    def spans(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """(start, end) of the tagged runs of each text, in code points."""
        tokens = [_TOKEN.findall(text) for text in texts]
        flat = list(chain.from_iterable(tokens))
        found: list[list[tuple[int, int]]] = [[] for _ in texts]
        if not flat:
            return found
        sizes = np.array([len(x) for x in tokens])
        text = np.repeat(np.arange(len(texts)), sizes)
        files = np.array([_file_features(x) for x in tokens], dtype=np.float32)
        labels = tags(self.model, self.model.scores(self._tables(flat), files, text), np.append(True, text[1:] != text[:-1]))
        firsts = np.cumsum(sizes) - sizes
        for row in np.unique(text[labels != OUTSIDE]).tolist():
            own = labels[firsts[row] : firsts[row] + sizes[row]].tolist()
            for match, label in zip(_TOKEN.finditer(texts[row]), own, strict=True):
                if label == BEGIN:
                    found[row].append((match.start(), match.end()))
                elif label == INSIDE:
                    found[row][-1] = (found[row][-1][0], match.end())
        return found


def _tagger(shared: Broadcast) -> Tagger:
    model = shared.value
    if not hasattr(model, "tagger"):
        model.tagger = Tagger(model)
    return model.tagger


def beyond(tagged: list[tuple[int, int]], base: list[tuple[int, int, str, int]]) -> list[tuple[int, int]]:
    """The parts of the field's spans of 6 characters or more that no pattern's span covers; both lists by start."""
    parts, at = [], 0
    covered: list[list[int]] = []
    for start, end, _, _ in base:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    for start, end in tagged:
        if end - start < LEAST["assign"]:
            continue
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        i = at
        while i < len(covered) and covered[i][0] < end:
            if start < covered[i][0]:
                parts.append((start, covered[i][0]))
            start = covered[i][1]
            i += 1
        if start < end:
            parts.append((start, end))
    return parts


def all_spans(tagger: Tagger, texts: list[str]) -> list[list[tuple[int, int, str, int]]]:
    """The spans of the patterns, and what the field's spans of 6 characters or more have beyond them."""
    out = []
    for text, tagged in zip(texts, tagger.spans(texts), strict=True):
        base = base_spans(text)
        more = [(a, b, TAGGED, a) for a, b in beyond(tagged, base)]
        out.append(sorted(base + more, key=lambda span: (span[0], (*KINDS, TAGGED).index(span[2]))))
    return out


def _joined(spans: list[tuple[int, int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, _ in spans)


def secrets(docs: DataFrame, model: Model, spark: SparkSession) -> DataFrame:
    """doc_id, the number of each kind, base_sha256 (of the patterns' spans), spans and n_tagged of each row.

    Spans are written kind:start:end, by start and then kind, in code points with the end excluded. Null and empty
    texts have none. Texts are read whole. Rows that repeat are scanned each, other columns ignored; no rows give none.
    """
    shared = spark.sparkContext.broadcast(model)
    counted = (*KINDS, TAGGED)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = all_spans(_tagger(shared), strings(batch, "text"))
            base = [_joined([span for span in spans if span[2] != TAGGED]) for spans in found]
            columns = {f"n_{kind}": pa.array([sum(s[2] == kind for s in x) for x in found], pa.int64()) for kind in counted}
            columns["base_sha256"] = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string())
            columns["spans"] = pa.array([_joined(x) for x in found], pa.string())
            yield with_columns(batch, ["doc_id"], columns)

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kinds = ", ".join(f"n_{kind} long" for kind in counted)
    return in_batches(rows, job, extended(rows, ["doc_id"], f"{kinds}, base_sha256 string, spans string"))


def _masked(text: str, tagged: list[tuple[int, int]], mark: str) -> str:
    """The text with the values of the patterns' spans and what the field's have beyond replaced, what overlaps or
    touches by one mark."""
    base = base_spans(text)
    values = [(value, end) for _, end, _, value in base] + beyond(tagged, base)
    parts, at, last = [], 0, -1
    for start, end in sorted(values):
        if start > last:
            parts += [text[at:start], mark]
        at = last = max(last, end)
    return "".join([*parts, text[at:]])


def redacted(docs: DataFrame, model: Model, spark: SparkSession, mark: str = "[SECRET]") -> DataFrame:
    """The documents with each secret's value replaced by a mark; overlapping ones by one. All columns and rows stay.

    What is replaced is the values of just the spans that ``secrets`` gives. Null texts stay null.
    """
    shared = spark.sparkContext.broadcast(model)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            tagged = _tagger(shared).spans([text or "" for text in texts])
            new = [_masked(text, found, mark) if text else text for text, found in zip(texts, tagged, strict=True)]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return in_batches(docs, job, docs.schema)
