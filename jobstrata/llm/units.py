"""Texts cut into units that no token crosses, and ids remembered per unit.

A unit begins at a blank that follows anything but white space, so it holds its leading blanks
and all up to the next such place. Byte-level tokenizers that take a word with one blank before
it, and piece tokenizers that mark a blank at a piece's beginning alone, never have a token that
crosses such a place. Natural text has few different units, so each is encoded about once.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Units and numbers that a worker remembers; beyond, it starts anew.
UNITS_KEPT = 300_000
NUMBERS_KEPT = 4_000_000
# Longer units are encoded each time they are met.
LONGEST_KEPT = 64


def spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each behind one blank, and where each begins; null and empty
    texts have none."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    front = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ").cast(pa.large_string())
    joined = pc.binary_join_element_wise(front, texts, pa.scalar("", pa.large_string()))
    if isinstance(joined, pa.ChunkedArray):
        joined = joined.combine_chunks()
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset :][: len(joined) + 1]
    data = joined.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def unit_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where units begin; texts lie between ``bounds`` and begin with a blank."""
    places = np.flatnonzero(data == 0x20)
    places = places[places > 0]
    before = data[places - 1]
    white = (before <= 0x20) & ((before == 0x20) | ((before >= 9) & (before <= 13)) | (before >= 28))
    # White space outside ASCII, by its last, second and third byte from the end.
    far = np.flatnonzero(before >= 0x80)
    at = places[far]
    last, second, third = before[far], data[at - 2], data[at - 3]
    line = (last <= 0x8A) | (last == 0xA8) | (last == 0xA9) | (last == 0xAF)
    general = ((second == 0x80) & line) | ((second == 0x81) & (last == 0x9F))
    white[far] = (
        ((second == 0xC2) & ((last == 0x85) | (last == 0xA0)))
        | ((third == 0xE2) & general)
        | ((third == 0xE1) & (second == 0x9A) & (last == 0x80))
        | ((third == 0xE3) & (second == 0x80) & (last == 0x80))
    )
    starts = np.zeros(len(data) + 1, bool)
    starts[places[~white]] = True
    starts[bounds] = True
    return np.flatnonzero(starts[:-1])


def coded(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Codes of the units in order, and the different units as strings."""
    offsets = np.append(starts, len(data)).astype(np.int64)
    array = pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    ).dictionary_encode()
    return array.indices.to_numpy(), array.dictionary


class Remembered:
    """Numbers per unit, made by ``encode`` and kept for later batches.

    ``encode`` is given units as an array and as a list, and returns flat numbers, and where each
    unit's begin there and how many they are.
    """

    def __init__(self, encode: Callable, kind, most: int = UNITS_KEPT):
        self.encode = encode
        self.kind = kind
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, self.kind), 0
        self.begins, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def rows(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat numbers, and where each unit's begin and how many they are."""
        if len(self.place) > self.most or self.used > NUMBERS_KEPT:
            self._forget()
        words = units.to_numpy(zero_copy_only=False)
        known, n = self.place, len(words)
        found = np.fromiter(map(known.get, words, repeat(-1)), np.int64, n)
        missing = np.flatnonzero(found < 0)
        if not len(missing):
            return self.flat[: self.used], self.begins[found], self.lengths[found]
        fresh = words[missing].tolist()
        taken = units.take(pa.array(missing))
        flat, begins, lengths = self.encode(taken, fresh)
        # Long units are not found again; what they took is given back when all is forgotten.
        short = pc.less_equal(pc.binary_length(taken), LONGEST_KEPT).to_numpy(False)
        first = len(self.begins)
        self.begins = np.concatenate([self.begins, self.used + begins])
        self.lengths = np.concatenate([self.lengths, lengths])
        end = self.used + len(flat)
        if end > len(self.flat):
            room = np.zeros(2 * end, self.kind)
            room[: self.used] = self.flat[: self.used]
            self.flat = room
        self.flat[self.used : end] = flat
        found[missing] = first + np.arange(len(missing))
        out = self.flat[:end], self.begins[found], self.lengths[found]
        self.used = end
        numbers = range(first, first + len(fresh))
        if short.all():
            known.update(zip(fresh, numbers))
        else:
            known.update((w, i) for w, i, s in zip(fresh, numbers, short.tolist()) if s)
        return out


def joined(
    units: pa.Array,
    words: list[str],
    whole: Callable[[str], list[int] | None],
    alone: Callable[[str], list[int]],
    widths: np.ndarray,
    most: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of units, as ``Remembered`` takes them. Those that end with other than white space are
    encoded ``most`` at once by ``whole`` and cut by the bytes that their ids spell, ``widths``;
    the others, and those of a call that gives None, one by one by ``alone``."""
    single = np.fromiter((w[-1:].isspace() for w in words), bool, len(words))
    order = np.flatnonzero(~single)
    sizes = pc.binary_length(units).to_numpy(zero_copy_only=False)
    begins, lengths = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    parts, used = [], 0
    for a in range(0, len(order), most):
        part = order[a : a + most]
        told = whole("".join([words[i] for i in part.tolist()]))
        if told is None:
            single[part] = True
            continue
        told = np.array(told, np.int32)
        cuts = np.searchsorted(np.cumsum(widths[told]), np.cumsum(sizes[part])) + 1
        lengths[part] = np.diff(cuts, prepend=0)
        begins[part] = used + cuts - lengths[part]
        parts.append(told)
        used += len(told)
    for i in np.flatnonzero(single).tolist():
        told = np.array(alone(words[i]), np.int32)
        begins[i], lengths[i] = used, len(told)
        parts.append(told)
        used += len(told)
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), begins, lengths
