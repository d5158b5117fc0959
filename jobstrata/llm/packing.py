"""Bounded-space online packing of tokenized documents into sequences of fixed length.

A task reads its documents once and keeps a fixed number of windows open. A document goes
whole into the window that it fills best; parts of a full window's length are windows of
their own. If it fits nowhere and no more windows may be open, it is cut: its head fills the
fullest window, which is emitted, and its tail opens a new one. The windows open at the end
of a task are merged by the same rule over groups of tasks, in levels; at the root what is
left is laid end to end, so that one sequence in all may be short.

Defined cases: null and empty texts have the end token alone; texts of any length are cut;
repeated rows are packed as often as they occur; ids may be null; other columns are ignored;
an empty table gives no sequences.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.common import give_back, map_arrow, ranges, stored, text_batches
from jobstrata.llm.units import Remembered

OPEN_WINDOWS = 16
# Tasks, or groups of the level below, whose open windows are merged in one task.
FAN_IN = 16
# Words of each kind that a worker remembers, and bytes of text that it handles at once.
WORDS_KEPT, TEXT_BYTES = 200_000, 1 << 20
_PIECE = (
    "start long, length long, doc_tokens long, ids binary, sequence_id long, offset long, "
    "node long, open boolean"
)


# How a tokenizer reads texts for which ``Words`` holds: fixed values.
_WORD_FORM = {
    "normalizers": ["NFC", "Replace", "Lowercase"],
    "blanks": {"Regex": r"\s+"},
    "words": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
}


def reads_words(tokenizer) -> bool:
    """Whether a tokenizer lowers its texts and takes words and signs apart at blanks, so that
    ids of words follow each other as the words do."""
    if tokenizer.normalizer is None or tokenizer.pre_tokenizer is None:
        return False
    steps = json.loads(tokenizer.normalizer.__getstate__()).get("normalizers", [])
    splits = json.loads(tokenizer.pre_tokenizer.__getstate__()).get("pretokenizers", [])
    if [s["type"] for s in steps] != _WORD_FORM["normalizers"] or len(splits) != 2:
        return False
    added = (token.content for token in tokenizer.get_added_tokens_decoder().values())
    return (
        steps[1]["pattern"] == _WORD_FORM["blanks"]
        and steps[1]["content"] == " "
        and splits[0].get("pattern") == _WORD_FORM["words"]
        and (splits[0].get("behavior"), splits[0].get("invert")) == ("Removed", True)
        and splits[1]["type"] == "ByteLevel"
        and not splits[1]["use_regex"]
        and not splits[1]["add_prefix_space"]
        and not any(set(content) & set(" \n") for content in added)
    )


def _joined(parts: list, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts in a row, each followed by ``end_id``, and where texts begin."""
    bounds = np.r_[0, np.cumsum(lengths + 1)]
    out = np.empty(bounds[-1], np.uint32)
    last = np.zeros(len(out), bool)
    last[bounds[1:] - 1] = True
    out[last] = end_id
    if parts:
        out[~last] = np.concatenate(parts)
    return out, bounds


class Whole:
    """Token ids of whole texts, by a tokenizer of any form."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def ids(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, each text's followed by ``end_id``, and where texts begin."""
        words = pc.fill_null(texts, "").to_pylist()
        told = self.tokenizer.encode_batch(words, add_special_tokens=False)
        parts = [np.array(t.ids, np.uint32) for t in told]
        return _joined(parts, np.fromiter(map(len, parts), np.int64, len(parts)), end_id)


class Words(Whole):
    """Token ids word by word, for tokenizers that ``reads_words``.

    Most words are letters, perhaps with a full stop or comma behind. The tokenizer lowers and
    separates those, so they share the ids of their lower-case letters.
    """

    def __init__(self, tokenizer):
        super().__init__(tokenizer)
        self.letters = Remembered(self._letter_ids, np.uint32, WORDS_KEPT)
        self.others = Remembered(self._other_ids, np.uint32, WORDS_KEPT)
        told = self.tokenizer.encode_batch([".", ","], add_special_tokens=False)
        self.stops = np.array([0, *(t.ids[0] for t in told)], np.uint32)

    def _letter_ids(self, units: pa.Array, words: list[str]) -> tuple[np.ndarray, ...]:
        """Words of letters are one unit of the tokenizer each, so many go in one call."""
        lengths = np.zeros(len(words), np.int64)
        filled = np.flatnonzero(pc.binary_length(units).to_numpy(zero_copy_only=False))
        parts = []
        for a in range(0, len(filled), 4096):
            part = filled[a : a + 4096]
            text = " ".join([words[i] for i in part.tolist()])
            told = self.tokenizer.encode(text, add_special_tokens=False)
            parts.append(np.array(told.ids, np.uint32))
            lengths[part] = np.bincount(np.array(told.word_ids, np.int64), minlength=len(part))
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        return flat, np.cumsum(lengths) - lengths, lengths

    def _other_ids(self, units: pa.Array, words: list[str]) -> tuple[np.ndarray, ...]:
        told = self.tokenizer.encode_batch(words, add_special_tokens=False)
        lengths = np.fromiter((len(t) for t in told), np.int64, len(told))
        flat = np.fromiter(chain.from_iterable(t.ids for t in told), np.uint32, lengths.sum())
        return flat, np.cumsum(lengths) - lengths, lengths

    def _spelled(self, words: pa.Array) -> tuple[np.ndarray, ...]:
        """Of different words: flat ids, begins and lengths there, and the stop behind."""
        dot, comma = pc.ends_with(words, "."), pc.ends_with(words, ",")
        stop = dot.to_numpy(zero_copy_only=False) + 2 * comma.to_numpy(zero_copy_only=False)
        core = pc.if_else(pc.or_(dot, comma), pc.utf8_slice_codeunits(words, 0, -1), words)
        low = pc.utf8_lower(core)
        plain = pc.or_(pc.utf8_is_alpha(low), pc.equal(pc.binary_length(low), 0))
        plain = plain.to_numpy(zero_copy_only=False) & ~(_far(core) | _far(low))
        letters, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        cores = low.take(pa.array(letters)).dictionary_encode()
        flat, begin, many = self.letters.rows(cores.dictionary)
        place = cores.indices.to_numpy()
        odd, odd_begin, odd_many = self.others.rows(words.take(pa.array(others)))
        begins, lengths = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        begins[letters], lengths[letters] = begin[place], many[place]
        begins[others], lengths[others] = len(flat) + odd_begin, odd_many
        stop[others] = 0
        return np.concatenate([flat, odd]), begins, lengths, stop

    def ids(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, each text's followed by ``end_id``, and where texts begin."""
        plain = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        split = pc.split_pattern(plain, " ")
        words = split.flatten().dictionary_encode()
        flat, begins, lengths, stop = self._spelled(words.dictionary)
        place = words.indices.to_numpy()
        core, behind = lengths[place], stop[place]
        each = core + (behind > 0)
        before = np.cumsum(each) - each
        tokens = np.empty(int(each.sum()), np.uint32)
        tokens[ranges(before, core)] = flat[ranges(begins[place], core)]
        stopped = np.flatnonzero(behind)
        tokens[before[stopped] + core[stopped]] = self.stops[behind[stopped]]
        in_text = np.diff(split.offsets.to_numpy())
        through = np.r_[0, np.cumsum(each)][np.cumsum(in_text)]
        return _joined([tokens], np.diff(through, prepend=0), end_id)


def spelled_by(path: str) -> Whole:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return Words(tokenizer) if reads_words(tokenizer) else Whole(tokenizer)


def _far(words: pa.Array) -> np.ndarray:
    """Words with a sign from U+0240 on, or with U+0130, whose small form has two signs; the
    tokenizer's own tables are left to deal with these."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset :][: len(words) + 1]
    data = words.buffers()[2]
    found = np.zeros(len(words), bool)
    if data is None or not len(words):
        return found
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    far = raw >= 0xC9
    far[:-1] |= (raw[:-1] == 0xC4) & (raw[1:] == 0xB0)
    found[np.searchsorted(offsets - offsets[0], np.flatnonzero(far), "right") - 1] = True
    return found


class Packer:
    """Open windows and what has been emitted; pieces are (key, start, total, ids)."""

    def __init__(self, length: int, first_sequence: int):
        self.length = length
        self.next = first_sequence
        self.windows: list[tuple[int, list]] = []
        self.rows: list[tuple] = []

    def _emit(self, pieces: list, is_open: bool = False) -> None:
        offset = 0
        for key, start, total, ids in pieces:
            n = len(ids) // 4
            self.rows.append((key, start, n, total, ids, self.next, offset, is_open))
            offset += n
        self.next += 1

    def add(self, key, start: int, total: int, ids: bytes) -> None:
        width = 4 * self.length
        while len(ids) >= width:
            self._emit([(key, start, total, ids[:width])])
            start, ids = start + self.length, ids[width:]
        size = len(ids) // 4
        if not size:
            return
        fits = [i for i, (used, _) in enumerate(self.windows) if used + size <= self.length]
        if fits:
            best = max(fits, key=lambda i: self.windows[i][0])
            used, pieces = self.windows[best]
            pieces.append((key, start, total, ids))
            self.windows[best] = (used + size, pieces)
            if used + size == self.length:
                self._emit(self.windows.pop(best)[1])
            return
        if len(self.windows) >= OPEN_WINDOWS:
            fullest = max(range(len(self.windows)), key=lambda i: self.windows[i][0])
            used, pieces = self.windows.pop(fullest)
            head = self.length - used
            pieces.append((key, start, total, ids[: 4 * head]))
            self._emit(pieces)
            start, ids = start + head, ids[4 * head :]
            size -= head
        self.windows.append((size, [(key, start, total, ids)]))

    def join(self) -> None:
        """Lay the open windows end to end; only the last may be short."""
        pieces, room = [], self.length
        for _, held in self.windows:
            for key, start, total, ids in held:
                while ids:
                    part, ids = ids[: 4 * room], ids[4 * room :]
                    pieces.append((key, start, total, part))
                    start, room = start + len(part) // 4, room - len(part) // 4
                    if not room:
                        self._emit(pieces)
                        pieces, room = [], self.length
        if pieces:
            self._emit(pieces)
        self.windows = []

    def close(self) -> None:
        for _, pieces in self.windows:
            self._emit(pieces, is_open=True)
        self.windows = []

    def taken(self, node: int, keys: pa.Array) -> pa.Table:
        """Emitted rows; piece keys are positions in ``keys``, the documents' ids."""
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) or [()] * 8
        kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 2 + [pa.bool_()]
        names = ["start", "length", "doc_tokens", "ids", "sequence_id", "offset", "open"]
        table = {"doc_id": keys.take(pa.array(columns[0], pa.int64()))}
        table |= {n: pa.array(c, k) for n, c, k in zip(names, columns[1:], kinds)}
        table["node"] = pa.array([node] * len(rows), pa.int64())
        order = ["doc_id", *names[:-1], "node", "open"]
        return pa.table({n: table[n] for n in order})


_WORDS: dict[str, Whole] = {}


def _pack_task(
    batches: Iterator[pa.RecordBatch], path: str, length: int, end_id: int
) -> Iterator[pa.RecordBatch]:
    if path not in _WORDS:
        # What earlier steps and the tokenizer's file took and no longer use is given back, so
        # that workers of one executor don't hold it beside their words.
        give_back()
        _WORDS[path] = spelled_by(path)
        give_back()
    task = TaskContext.get().partitionId()
    packer, held = Packer(length, task << 32), None
    for batch in text_batches(batches, "text", TEXT_BYTES):
        tokens, bounds = _WORDS[path].ids(batch.column("text"), end_id)
        # Documents of the windows still open come before those of this batch.
        keys = batch.column("doc_id")
        shift = 0 if held is None else len(held)
        keys = keys if held is None else pa.concat_arrays([held, keys])
        raw = tokens.tobytes()
        for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            packer.add(shift + row, 0, b - a, raw[4 * a : 4 * b])
        yield from packer.taken(task, keys).to_batches()
        open_keys = sorted({p[0] for _, pieces in packer.windows for p in pieces})
        held = keys.take(pa.array(open_keys, pa.int64()))
        place = {k: i for i, k in enumerate(open_keys)}
        packer.windows = [
            (used, [(place[p[0]], *p[1:]) for p in pieces]) for used, pieces in packer.windows
        ]
    if held is not None:
        packer.close()
        yield from packer.taken(task, held).to_batches()


def _merge(level: int, length: int, root: bool):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        node = key[0].as_py()
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        packer = Packer(length, level << 56 | node << 32)
        columns = (table["start"], table["doc_tokens"], table["ids"])
        rows = zip(*(c.to_pylist() for c in columns))
        for row, (start, total, ids) in enumerate(rows):
            packer.add(row, start, total, ids)
        packer.join() if root else packer.close()
        return packer.taken(node, table["doc_id"].combine_chunks())

    return run


def pack(docs: DataFrame, path: str, length: int = 4096, end_id: int = 2) -> DataFrame:
    """Pieces of sequences: doc_id, start (ids of its document before it), length, doc_tokens,
    ids (unsigned 32-bit, little-endian), sequence_id and offset in the sequence.

    ``path`` is a tokenizer file that tasks can open; every document ends with ``end_id``.
    """
    rows = docs.select("doc_id", "text")
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {_PIECE}"
    pieces = stored(map_arrow(rows, _pack_task, schema, path, length, end_id), "packed")
    done = pieces.where("NOT open")
    nodes = (pieces.agg(F.max("node")).first()[0] or 0) + 1
    level = 0
    while level == 0 or nodes > 1:
        level, nodes = level + 1, -(-nodes // FAN_IN)
        left = pieces.where("open").withColumn("node", F.floor(F.col("node") / FAN_IN))
        merged = left.groupBy("node").applyInArrow(_merge(level, length, nodes == 1), schema)
        pieces = stored(merged, f"packed-{level}")
        done = done.unionByName(pieces.where("NOT open"))
    return done.drop("node", "open")
