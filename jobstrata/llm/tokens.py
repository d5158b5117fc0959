"""Token counts by a byte-level BPE compiled to finite-state transducers.

Two deterministic transducers run one after the other. The first reads character classes and
emits where words (the units that merges never cross) begin. The characters of a batch of
texts are cut into chunks of equal length; each chunk becomes a map from entry states to exit
states, the maps compose by a parallel prefix scan, and all chunks then run side by side from
their true entry states. The second reads the bytes of a word. Its state is what the merges
can still depend on: the longest suffix that may grow into a token, and the last token and
count at each boundary inside. A transition's emission is by how much the number of tokens
changes, so a word's count is the sum along its path. States are made when first reached.

Defined cases: null and empty texts have 0 tokens; texts of any length are read in chunks;
repeated rows count alike; other columns are kept, those called like an output are replaced.
Strings of special tokens inside a text count as one token each, as the library has it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata.llm.common import map_arrow, text_batches
from jobstrata.llm.units import Remembered

# Symbols of the first transducer.
_SYMBOLS = "letter s r v l e number space blank quote other end".split()
LETTER, S, R, V, L, E, NUMBER, SPACE, BLANK, QUOTE, OTHER, END = range(len(_SYMBOLS))
_LETTERS = (LETTER, S, R, V, L, E)
# Its states: the open word is ... (runs are of blanks; a quote may begin a contraction).
_STATES = "none letters numbers others space blank run_space run_blank quote q_r q_v q_l".split()
NONE, LETTERS, NUMBERS, OTHERS, ONE_SPACE, ONE_BLANK, RUN_SPACE, RUN_BLANK, Q, QR, QV, QL = range(
    len(_STATES)
)
# Emissions: a word begins at this character, at the one before, or at both.
HERE, BEFORE = 1, 2
CHUNK = 512
# Bounds of what a worker remembers; past them it starts anew.
STATES_KEPT = 150_000


def _step(state: int, symbol: int) -> tuple[int, int]:
    """Next state and emission."""
    if symbol == END:
        # A run of blanks that ends a text is one word; a quote and one letter are two.
        return NONE, HERE | (BEFORE if state in (QR, QV, QL) else 0)
    if state in (QR, QV, QL):
        if (state, symbol) in ((QR, E), (QV, E), (QL, L)):
            return NONE, 0
        following, emitted = _step(LETTERS, symbol)
        return following, emitted | BEFORE
    if symbol in (SPACE, BLANK):
        if state in (ONE_SPACE, ONE_BLANK, RUN_SPACE, RUN_BLANK):
            return (RUN_SPACE if symbol == SPACE else RUN_BLANK), 0
        return (ONE_SPACE if symbol == SPACE else ONE_BLANK), HERE
    # The last blank of a longer run stands alone, or leads the next word if a space.
    late = BEFORE if state in (RUN_SPACE, RUN_BLANK) else 0
    led = state in (ONE_SPACE, RUN_SPACE)
    if state == Q and symbol in (S, R, V, L):
        return {S: NONE, R: QR, V: QV, L: QL}[symbol], 0
    if symbol == QUOTE:
        if led or state in (OTHERS, Q):
            return OTHERS, late
        return Q, late | HERE
    target = LETTERS if symbol in _LETTERS else NUMBERS if symbol == NUMBER else OTHERS
    open_states = {LETTERS: (LETTERS,), NUMBERS: (NUMBERS,), OTHERS: (OTHERS, Q)}[target]
    return target, late | (0 if led or state in open_states else HERE)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    cells = [[_step(s, c) for c in range(len(_SYMBOLS))] for s in range(len(_STATES))]
    both = np.array(cells, np.uint8)
    return both[..., 0].reshape(-1), both[..., 1].reshape(-1)


def word_starts(symbols: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Whether a word begins at each symbol; a text ends with END, which is a word too."""
    following, emitted = _tables()
    width = np.uint8(len(_SYMBOLS))
    lanes = -(-len(symbols) // chunk)
    padded = np.full(lanes * chunk, END, np.uint8)
    padded[: len(symbols)] = symbols
    # Row by row the next symbol of every chunk.
    rows = np.ascontiguousarray(padded.reshape(lanes, chunk).T)
    exits = np.tile(np.arange(len(_STATES), dtype=np.uint8), (lanes, 1))
    agreed = np.zeros(lanes, bool)
    single = np.zeros(lanes, np.uint8)
    for at, row in enumerate(rows):
        if not agreed.all():
            moving = ~agreed
            exits[moving] = following[exits[moving] * width + row[moving, None]]
        if agreed.any():
            single = following[single * width + row]
        if at % 32 == 31 and not agreed.all():
            met = ~agreed & (exits == exits[:, :1]).all(1)
            single[met] = exits[met, 0]
            agreed |= met
    exits[agreed] = single[agreed, None]
    # Inclusive scan: after it, row i maps entry states of chunk 0 to exit states of chunk i.
    reach = 1
    while reach < lanes:
        earlier = exits[:-reach]
        exits[reach:] = np.take_along_axis(exits[reach:], earlier.astype(np.int64), axis=1)
        reach *= 2
    state = np.r_[np.uint8(NONE), exits[:-1, NONE]]
    marks = np.empty_like(rows)
    for at, row in enumerate(rows):
        cell = state * width + row
        marks[at] = emitted[cell]
        state = following[cell]
    marks = np.ascontiguousarray(marks.T).reshape(-1)[: len(symbols)]
    starts = (marks & HERE) > 0
    starts[:-1] |= (marks[1:] & BEFORE) > 0
    return starts


def _byte_signs() -> dict[str, int]:
    """Signs that stand for bytes in the vocabulary: printable ones for themselves, the
    others in order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class WordTransducer:
    """Number of tokens of a word, by transitions over its bytes."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        sign = _byte_signs()
        spell = lambda token: bytes(sign[c] for c in token)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.rank = {(spell(a), spell(b)): i for i, (a, b) in enumerate(pairs)}
        self.tokens = {spell(t) for t in vocabulary if all(c in sign for c in t)}
        self.beginnings = {t[:n] for t in self.tokens for n in range(1, len(t) + 1)}
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self._forget()

    def _forget(self) -> None:
        # A state: suffix, then last token and relative count at each boundary inside it,
        # its own start first. The empty token stands for the start of the word.
        self.states: list[tuple] = [(b"", (b"",), (0,))]
        self.known = {self.states[0]: 0}
        self.moves: list[dict[int, tuple[int, int]]] = [{}]
        if len(self.fits) > STATES_KEPT:
            self.fits = {}

    def merged(self, text: bytes) -> list[bytes]:
        """Tokens by the definition: the pair of lowest rank first."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            ranks = [self.rank.get(p, 1 << 30) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 30:
                break
            pair, joined, i = ranks.index(best), [], 0
            first, second = parts[pair], parts[pair + 1]
            while i < len(parts):
                if i + 1 < len(parts) and parts[i] == first and parts[i + 1] == second:
                    joined.append(first + second)
                    i += 2
                else:
                    joined.append(parts[i])
                    i += 1
            parts = joined
        return parts

    def _fit(self, left: bytes, right: bytes) -> bool:
        """Whether the two stay apart, as they are, when merged together."""
        key = (left, right)
        found = self.fits.get(key)
        if found is None:
            found = self.merged(left + right) == ([left, right] if left else [right])
            self.fits[key] = found
        return found

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        suffix, lasts, counts = self.states[state]
        grown = suffix + bytes((byte,))
        # The one token that can end here: it stays apart from the last token before it.
        for at in range(len(grown)):
            token = grown[at:]
            if token in self.tokens and self._fit(lasts[at], token):
                break
        else:
            raise ValueError("the vocabulary lacks a byte")
        change = counts[at] + 1
        keep = next((i for i in range(len(grown)) if grown[i:] in self.beginnings), len(grown))
        target = (
            grown[keep:],
            (*lasts[keep:], token),
            (*(c - change for c in counts[keep:]), 0),
        )
        number = self.known.get(target)
        if number is None:
            number = self.known[target] = len(self.states)
            self.states.append(target)
            self.moves.append({})
        self.moves[state][byte] = (number, change)
        return number, change

    def count(self, word: bytes) -> int:
        if len(self.states) > STATES_KEPT:
            self._forget()
        total = state = 0
        moves = self.moves
        for byte in word:
            state, change = moves[state].get(byte) or self._move(state, byte)
            total += change
        return total


def require_byte_level(path: str) -> dict:
    """What a tokenizer file says; one that does not take texts apart by bytes and the words of
    ``word_starts``, as they stand, is refused."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    form = told.get("pre_tokenizer") or {}
    byte_level = form.get("type") == "ByteLevel" and form.get("use_regex", True)
    if told.get("normalizer") or not byte_level or form.get("add_prefix_space"):
        raise ValueError(f"{path} is no byte-level tokenizer of texts as they stand")
    return told


class Compiled:
    """Both transducers of a tokenizer file, and its character classes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        told = require_byte_level(path)
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        specials = [t["content"] for t in told["added_tokens"]]
        by_length = sorted(specials, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, by_length))) if specials else None
        self.word = WordTransducer(told["model"]["vocab"], told["model"]["merges"])
        self.known = Remembered(self._word_counts, np.int64)
        self.symbol = np.full(0x110000, 255, np.uint8)
        for sign, symbol in zip("stmdrvle '", (S, S, S, S, R, V, L, E, SPACE, QUOTE)):
            self.symbol[ord(sign)] = symbol

    def _classify(self, codes: np.ndarray) -> None:
        """Classes of characters as the tokenizer itself splits them."""
        for code in np.unique(codes).tolist():
            sign = chr(code)
            for before, symbol in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
                if len(self.split(before + sign)) == 1:
                    self.symbol[code] = symbol
                    break
            else:
                self.symbol[code] = BLANK

    def _word_counts(self, units: pa.Array, words: list[bytes]) -> tuple[np.ndarray, ...]:
        counts = np.fromiter(map(self.word.count, words), np.int64, len(words))
        return counts, np.arange(len(words)), np.ones(len(words), np.int64)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        pieces, owner = [], []
        total = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = [text or ""]
            if self.special and self.special.search(parts[0]):
                parts = self.special.split(parts[0])
                total[i] = len(parts) - 1
            pieces += parts
            owner += [i] * len(parts)
        joined = "\0".join(pieces) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        symbols = self.symbol[codes]
        if (unknown := symbols == 255).any():
            self._classify(codes[unknown])
            symbols = self.symbol[codes]
        ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
        symbols[ends] = END
        begins = np.flatnonzero(word_starts(symbols))
        sizes = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        offsets = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
        bounds = np.r_[offsets[begins], offsets[-1]].astype(np.int64)
        words = pa.Array.from_buffers(
            pa.large_binary(),
            len(begins),
            [None, pa.py_buffer(bounds), pa.py_buffer(joined.encode("utf-8"))],
        ).dictionary_encode()
        flat, begin, _ = self.known.rows(words.dictionary)
        found = flat[begin][words.indices.to_numpy()]
        found[symbols[begins] == END] = 0
        piece = np.searchsorted(ends, begins)
        total += np.bincount(
            np.array(owner)[piece], weights=found, minlength=len(texts)
        ).astype(np.int64)
        return total


_COMPILED: dict[str, Compiled] = {}


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    if path not in _COMPILED:
        _COMPILED[path] = Compiled(path)
    for batch in text_batches(batches, "text", 2 << 20):
        tokens = _COMPILED[path].counts(batch.column("text").to_pylist())
        kept = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != "text"}
        yield pa.record_batch({**kept, "n_tokens": pa.array(tokens, pa.int64())})


def count_tokens(
    docs: DataFrame, path: str, limit: int, keep: list[str] | None = None
) -> DataFrame:
    """Columns of ``docs`` but its text (or only those of ``keep``) with n_bytes, n_tokens and
    over_limit; ``path`` is a tokenizer file that tasks can open."""
    kept = [
        c
        for c in (docs.columns if keep is None else keep)
        if c not in ("text", "n_bytes", "n_tokens", "over_limit")
    ]
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    rows = docs.select(*kept, size, "text")
    schema = T.StructType([*rows.drop("text").schema.fields]).add("n_tokens", "long")
    counted = map_arrow(rows, _count, schema, path)
    return counted.select("*", (F.col("n_tokens") > limit).alias("over_limit"))
