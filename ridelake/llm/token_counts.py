"""Token counts of a byte-level BPE, by finite-state transducers.

Two transducers are composed. The first is the vocabulary's rule for cutting a text into pieces (letters, digits,
other signs, white space, English contractions), compiled to a table over classes of characters; each transition
says whether a piece begins at this character, or at the one before (where the rule looks ahead). A slice of
texts is one sequence of classes that is cut into chunks; every chunk's map from states to states is computed at
once for all chunks, the maps are composed by a parallel prefix scan, and with each chunk's entry state known all
chunks run in step and mark where pieces begin.

The second (``Counting``) reads a piece byte by byte; each transition says by how much the byte changes the number of
tokens, which is also less than nothing, as a later byte can undo tokens. It is back in its first state wherever a
piece begins, so a piece's map is one number, and these are composed by a prefix sum. The maps of up to ``PIECES``
pieces are kept.
"""

from __future__ import annotations

import gc
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import extended, in_batches, slices, strings, with_columns

CHUNK = 512
#: Pieces whose counts are kept, states that are, and pairs of tokens known to stand side by side or not.
PIECES = 250_000
STATES = 150_000
PAIRS = 250_000

# -- the transducer that cuts pieces ---------------------------------------------

#: Classes of characters. END parts texts.
(STMD, R, V, L, E, LETTER, DIGIT, QUOTE, OTHER, SPACE, BLANK, END) = range(12)
#: States: what the last character was. DONE is the start, and the end of a contraction.
(DONE, IN_LETTERS, IN_DIGITS, IN_OTHERS, IN_SPACE, IN_BLANK, AFTER_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L) = range(10)
HERE, BEFORE = 1, 2

_LETTERS = (STMD, R, V, L, E, LETTER)
_RUNS = {**dict.fromkeys(_LETTERS, IN_LETTERS), DIGIT: IN_DIGITS, QUOTE: IN_OTHERS, OTHER: IN_OTHERS}
_BLANKS = {SPACE: IN_SPACE, BLANK: IN_BLANK}
_FRESH = {**_RUNS, **_BLANKS, QUOTE: AFTER_QUOTE, END: DONE}
#: White_Space of Unicode but for U+0020. A fixed value.
_WHITE = (*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def _step(state: int, kind: int) -> tuple[int, int]:
    """The next state, and where a piece begins."""
    fresh = (_FRESH[kind], HERE)
    if kind == END:
        return DONE, HERE | (BEFORE if state in (QUOTE_R, QUOTE_V, QUOTE_L) else 0)
    if state in (IN_LETTERS, IN_DIGITS, IN_OTHERS):
        return (state, 0) if _RUNS.get(kind) == state else fresh
    if state in (IN_SPACE, IN_BLANK):
        if kind in _BLANKS:
            return _BLANKS[kind], 0
        return (_RUNS[kind], BEFORE) if state == IN_SPACE else (fresh[0], BEFORE | HERE)
    if state == AFTER_QUOTE:
        begun = {STMD: DONE, R: QUOTE_R, V: QUOTE_V, L: QUOTE_L, QUOTE: IN_OTHERS, OTHER: IN_OTHERS}
        return (begun[kind], 0) if kind in begun else fresh
    if state in (QUOTE_R, QUOTE_V, QUOTE_L):
        if kind == (L if state == QUOTE_L else E):
            return DONE, 0
        return (IN_LETTERS, BEFORE) if kind in _LETTERS else (fresh[0], BEFORE | HERE)
    return fresh


_TABLE = np.array([[_step(state, kind) for kind in range(12)] for state in range(10)], dtype=np.uint8)
NEXT, MARKS = np.ascontiguousarray(_TABLE[:, :, 0]), np.ascontiguousarray(_TABLE[:, :, 1])


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each code point."""
    first = {"L": LETTER, "N": DIGIT}
    table = np.array([first.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], dtype=np.uint8)
    table[list(_WHITE)] = BLANK
    for text, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", STMD), ("r", R), ("v", V), ("l", L), ("e", E)):
        table[[ord(c) for c in text]] = kind
    return table


def entry_states(kinds: np.ndarray) -> np.ndarray:
    """The state before each chunk (a row of classes): the chunks' maps, composed by a prefix scan of doubling steps."""
    maps = np.tile(np.arange(len(NEXT), dtype=np.uint8), (len(kinds), 1))
    for column in kinds.T:
        maps = NEXT[maps, column[:, None]]
    span = 1
    while span < len(maps):
        maps = np.concatenate([maps[:span], np.take_along_axis(maps[span:], maps[:-span], axis=1)])
        span *= 2
    return np.concatenate([[DONE], maps[:-1, DONE]]).astype(np.uint8)


def piece_starts(kinds: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Whether a piece begins at each character of a sequence of classes that ends in END."""
    rows = np.concatenate([kinds, np.full(-len(kinds) % chunk, END, dtype=np.uint8)]).reshape(-1, chunk)
    state, marks = entry_states(rows), np.empty_like(rows)
    for k, column in enumerate(rows.T):
        marks[:, k] = MARKS[state, column]
        state = NEXT[state, column]
    marks = marks.ravel()[: len(kinds)]
    starts = (marks & HERE).astype(bool)
    starts[:-1] |= (marks[1:] & BEFORE).astype(bool)
    return starts


# -- the transducer that counts --------------------------------------------------


#: The first node of the tree of tokens, what is before the first token, and the rank of no merge.
ROOT, NOTHING, NEVER = 0, -1, 1 << 40
_BYTE = -1, NOTHING, NOTHING
_ZERO, _BELOW_NODE = 1 << 15, (1 << 36) - 1


class Vocabulary:
    """A byte-level BPE: its merges, and the special strings that are tokens within texts."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        cutter = spec.get("pre_tokenizer") or {}
        if cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True):
            raise ValueError(f"texts are cut by the byte-level rule only, not by {cutter}")
        of_character = {char: byte for byte, char in enumerate(_byte_characters())}
        self.bytes = [ids[char] for char in of_character]
        self.spelled = {ids[char]: bytes([byte]) for char, byte in of_character.items()}
        self.merges, self.made = {}, {}
        for rank, (one, other) in enumerate(m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]):
            new = ids[one + other]
            if new in self.spelled or ids[one] not in self.spelled or ids[other] not in self.spelled:
                raise ValueError(f"merge {rank} makes a token anew or of tokens that no merge before it makes")
            self.merges[ids[one], ids[other]], self.made[new] = (rank, new), (rank, ids[one], ids[other])
            self.spelled[new] = self.spelled[ids[one]] + self.spelled[ids[other]]
        self.special = [token["content"] for token in spec["added_tokens"]]

    def tokens(self, text: bytes) -> list[int]:
        """Of the pairs at hand the merge of lowest rank comes first, leftmost first."""
        ids = [self.bytes[byte] for byte in text]
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        merges, queue = self.merges, []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < len(ids) and (found := merges.get((ids[at], ids[after[at]]))):
                heapq.heappush(queue, (found[0], at, ids[at], ids[after[at]], found[1]))

        for at in range(len(ids) - 1):
            offer(at)
        while queue:
            _, at, one, other, new = heapq.heappop(queue)
            nxt = after[at]
            if ids[at] != one or nxt >= len(ids) or ids[nxt] != other:
                continue
            ids[at], ids[nxt], after[at] = new, -1, after[nxt]
            if after[at] < len(ids):
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [token for token in ids if token >= 0]

    def apart(self, one: int, other: int) -> bool:
        """Whether no merge joins the last bytes of one token with the first of another that stands behind it.

        A merge comes after those that make its parts, so ranks never fall while a text is merged. At the rank of a merge
        across the border each side there is what was made before and isn't part of more until then; where both
        sides' next merge is this one too (of a token with itself), the leftmost is first.
        """
        until_one = until_other = NEVER
        while True:
            rank, _ = self.merges.get((one, other), (NEVER, NOTHING))
            if rank < until_one and rank <= until_other:
                return False
            (rank_one, _, end), (rank_other, begin, _) = self.made.get(one, _BYTE), self.made.get(other, _BYTE)
            if rank_one == rank_other == -1:
                return True
            if rank_one > rank_other:
                until_one, one = rank_one, end
            else:
                until_other, other = rank_other, begin


class Counting:
    """The transducer from a piece's bytes to its number of tokens, compiled as far as texts need it.

    Tokens are those of the merges just when any two neighbours are what the merges make of their bytes. So the tokens
    of what was read end in one token only that begins where its forerunners' tokens end and that may follow the last
    of them. A state holds every place where a token may have begun that isn't over yet: its node in the tree of
    tokens, the token before it, and how many tokens there are up to it, more or less than up to here. A byte moves all
    nodes on; the one that now ends in a token which may follow says how many tokens there are. Nodes, tokens and
    differences are bounded by the vocabulary, so the states are finite. They are made when first reached, and made
    anew when there are ``STATES``, which changes no count.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.children: dict[int, int] = {}
        self.ends = [NOTHING]
        if max(map(len, vocabulary.spelled.values())) >= _ZERO or max(vocabulary.spelled) >= 1 << 20:
            raise ValueError("places are kept as numbers of 20 bits for a token and 16 bits for its length")
        for token, spelled in vocabulary.spelled.items():
            node = ROOT
            for byte in spelled:
                found = self.children.setdefault(node << 8 | byte, len(self.ends))
                if found == len(self.ends):
                    self.ends.append(NOTHING)
                node = found
            self.ends[node] = token
        self.inner = {key >> 8 for key in self.children}
        self.pairs: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.held: list[tuple[int, ...]] = []
        self.states: dict[tuple[int, ...], int] = {}
        self.transitions: dict[int, int] = {}
        self._state((_place(ROOT, NOTHING),))

    def _state(self, held: tuple[int, ...]) -> int:
        state = self.states.setdefault(held, len(self.held))
        if state == len(self.held):
            self.held.append(held)
        return state

    def _may_follow(self, before: int, token: int) -> bool:
        pair = before + 1 << 20 | token
        found = self.pairs.get(pair)
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            if before == NOTHING:
                found = self.vocabulary.tokens(self.vocabulary.spelled[token]) == [token]
            else:
                found = self._may_follow(NOTHING, token) and self.vocabulary.apart(before, token)
            self.pairs[pair] = found
        return found

    def _compiled(self, state: int, byte: int) -> int:
        """The transition of a state by a byte: the next state and the change of the number of tokens, in one number."""
        held = self.held[state]
        if len(self.held) >= STATES:
            self._forget()
            state = self._state(held)
        children, ends, inner = self.children, self.ends, self.inner
        moved, last, change = [], NOTHING, 0
        for place in held:
            node = children.get(place >> 36 << 8 | byte)
            if node is None:
                continue
            token = ends[node]
            if last == NOTHING and token != NOTHING and self._may_follow((place >> 16 & 0xFFFFF) - 1, token):
                last, change = token, (place & 0xFFFF) - _ZERO + 1
            if node in inner:
                moved.append(node << 36 | place & _BELOW_NODE)
        # Numbers of tokens are the lowest bits, so that subtracting from them leaves the others.
        held = (*[place - change for place in moved], _place(ROOT, last))
        found = self.transitions[state << 8 | byte] = self._state(held) << 16 | change + _ZERO
        return found

    def emitted(self, piece: bytes) -> int:
        """The number of tokens of a piece of any length."""
        transitions, state, count = self.transitions, 0, 0
        for byte in piece:
            found = transitions.get(state << 8 | byte)
            if found is None:
                found = self._compiled(state, byte)
                transitions = self.transitions
            state = found >> 16
            count += (found & 0xFFFF) - _ZERO
        return count


def _place(node: int, before: int) -> int:
    """A place in a state: the node, the token before, and no tokens more or less than up to here."""
    return node << 36 | before + 1 << 16 | _ZERO


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


class _Passing(dict):
    """Counts of one slice, before those that are kept."""

    def __init__(self, kept: dict[str, int]) -> None:
        super().__init__()
        self.kept = kept

    def __missing__(self, piece: str) -> int:
        return self.kept[piece]


class TokenCounter:
    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.counting = Counting(self.vocabulary)
        self.known: dict[str, int] = {}

    def _tokens(self, pieces: list[str]) -> np.ndarray:
        """The number of tokens of each piece; new ones are read once each."""
        known = self.known
        new = {piece: self.counting.emitted(piece.encode()) for piece in set(pieces).difference(known)}
        if len(known) + len(new) <= PIECES:
            known.update(new)
        else:
            known = _Passing(known)
            known.update(new)
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))

    def _cut(self, text: str) -> tuple[list[str], int]:
        """A text without its special strings, and their number."""
        parts, specials = [text], 0
        for special in self.vocabulary.special:
            if special in text:
                parts = [x for part in parts for x in part.split(special)]
                specials = len(parts) - 1
        return parts, specials

    def counts(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        cut = [self._cut(text) for text in texts]
        parts = [part for found, _ in cut for part in found]
        # The character after each part is overwritten by the class that parts texts.
        joined = "\n".join(parts) + "\n"
        kinds = _classes()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        kinds[ends] = END
        begins = np.flatnonzero(piece_starts(kinds))
        stops = np.append(begins[1:], len(kinds))
        real = kinds[begins] != END
        begins, stops = begins[real], stops[real]
        pieces = [joined[a:b] for a, b in zip(begins.tolist(), stops.tolist(), strict=True)]
        tokens = self._tokens(pieces)
        sums = np.concatenate([[0], np.cumsum(tokens)])
        at = np.searchsorted(begins, ends)
        of_part = np.diff(sums[at], prepend=0)
        first = np.cumsum([0] + [len(found) for found, _ in cut])[:-1]
        return np.add.reduceat(of_part, first) + np.array([specials for _, specials in cut]) if cut else of_part


@lru_cache(maxsize=2)
def _counter(path: str) -> TokenCounter:
    counter = TokenCounter(path)
    # The vocabulary's tables stay as long as the process does, so the collector needn't go through them again and again.
    gc.freeze()
    return counter


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; ``path`` is the vocabulary's file, there on every executor.

    Null texts count as empty, with no bytes and tokens. Special strings within texts are one token each. Texts are
    whole, however long. Rows that repeat are counted each; other columns are ignored; no rows give no rows.
    """

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts = _counter(path).counts(strings(batch, "text"))
            yield with_columns(batch, ["doc_id", "n_bytes"], {"n_tokens": pa.array(counts.astype(np.int64))})

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    counted = in_batches(rows, job, extended(rows, ["doc_id", "n_bytes"], "n_tokens long"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
