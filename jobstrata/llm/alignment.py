"""Alignment of two tokenizations of the same texts by pointer jumping.

Tokenizer A is byte-level and reads a blank and the text; tokenizer B has pieces and puts the
blank itself. Both spell the same bytes, so their tokens overlap in chains; a chain ends where
both have a token that ends. Every token points to the token that overlaps it and reaches
farthest to the right: of A's, the token of B that holds its last byte, and the other way
round, unless both end there; that token of B is the chain's terminal and points to itself. The
pointers of a batch are one array, which is replaced by its composition with itself until
nothing moves: after ``r`` rounds every token points ``2 ** r`` steps ahead, or to its terminal,
which labels its group.

A link is a token of A and one of B that end together, as each group has one. How often
a pair of ids is linked is counted over all documents: every task adds up what it has seen, and
the sums are combined. One of two linked tokens spells an end of the other, so at most as many
pairs exist as the tokens of both vocabularies have bytes, whatever the corpus; the table of
pairs is checked against that bound, sent to the tasks, and looked up by each stored link.

Texts are encoded by units (see ``units``) that each worker remembers. Batches are cut by bytes,
and a longer text is handled in stretches of whole units, which no token crosses, so memory
does not grow with it. Documents aren't shuffled.

Defined cases: null and empty texts, and texts whose pieces don't spell them (those that hold
B's sign for a blank), have no tokens: zeros and an empty string; repeated rows are aligned and
counted as often as they occur; ids may be null; other columns are kept, those called like an
output are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.common import map_arrow, ranges, stored, text_batches
from jobstrata.llm.tokens import _byte_signs, require_byte_level
from jobstrata.llm.units import Remembered, coded, joined, spaced, unit_starts

# Text handled at once; a longer one is handled in stretches of about this size.
STRETCH_BYTES = 1 << 20
# Pairs that a task adds up before it combines them.
PAIRS_HELD = 2_000_000
_BLANK = "▁"
_SUMS = ("n_a", "n_b", "n_groups", "n_links")
_DOCUMENT = ", ".join(f"{c} long" for c in _SUMS) + ", groups_sha256 string, links binary"
_OUTPUT = (*_SUMS, "n_best", "count_sum", "groups_sha256")


class Pair:
    """Both tokenizers: ids per unit, and how many bytes each id spells."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        require_byte_level(path_a)
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        sign = _byte_signs()
        spelled = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            spelled[i] = bytes(sign[c] for c in token if c in sign)
        self.bytes_a = np.array([len(s) for s in spelled], np.int64)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        marked = any(_BLANK in p.lstrip(_BLANK) for p in pieces)
        told = "".join(pieces[i] for i in self.b.encode("a  b "))
        if marked or told != f"{_BLANK}a{_BLANK * 2}b{_BLANK}":
            raise ValueError(f"{path_b} has other pieces than ones that begin at blanks")
        self.spelled_b = pa.array(
            [
                bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_BLANK, " ").encode()
                for i, p in enumerate(pieces)
            ],
            pa.large_binary(),
        )
        self.bytes_b = pc.binary_length(self.spelled_b).to_numpy()
        self.blank = self.b.piece_to_id(_BLANK)
        self.ids_a = Remembered(self._encoded_a, np.int32)
        self.ids_b = Remembered(self._encoded_b, np.int32)
        # Ids as text with what may follow them: within a side, and at the side's end.
        numbers = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.written = pa.array(
            [n + s for s in (",", "|", ";") for n in numbers], pa.large_string()
        )
        self.numbers = len(numbers)

    def _alone(self, unit: str) -> list[int]:
        return [self.blank] if unit == " " else self.b.encode(unit[1:])

    def _encoded_a(self, units: pa.Array, words: list[str]) -> tuple[np.ndarray, ...]:
        def whole(text: str) -> list[int]:
            return self.a.encode(text, add_special_tokens=False).ids

        return joined(units, words, whole, whole, self.bytes_a, 4096)

    def _encoded_b(self, units: pa.Array, words: list[str]) -> tuple[np.ndarray, ...]:
        """Ids of B; a unit that B does not spell as it is has the single id -1."""

        def alone(unit: str) -> list[int]:
            ids = [self.blank] if unit == " " else self.b.encode(unit[1:])
            return ids if self._spells(ids, unit) else [-1]

        def whole(text: str) -> list[int] | None:
            ids = self.b.encode(text[1:])
            return ids if self._spells(ids, text) else None

        return joined(units, words, whole, alone, self.bytes_b, 512)

    def _spells(self, ids: list[int], text: str) -> bool:
        taken = self.spelled_b.take(pa.array(ids, pa.int64()))
        size = int(self.bytes_b[ids].sum())
        return taken.buffers()[2].to_pybytes()[:size] == text.encode()

    def chains(self, eA: np.ndarray, eB: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terminals, as positions in B, of A's and of B's tokens by the ends of both."""
        first_b = np.searchsorted(eB, eA)
        first_a = np.searchsorted(eA, eB)
        shared = eA[first_a] == eB
        n = len(eA)
        pointer = np.r_[n + first_b, np.where(shared, n + np.arange(len(eB)), first_a)]
        while True:
            ahead = pointer[pointer]
            if np.array_equal(ahead, pointer):
                return pointer[:n] - n, pointer[n:] - n
            pointer = ahead

    def aligned(self, data: np.ndarray, bounds: np.ndarray) -> dict:
        """Of texts between ``bounds``: sums per text, the links of all in order, how many each
        has, the groups as text, and where each text's begin there."""
        starts = unit_starts(data, bounds)
        codes, units = coded(data, starts)
        text_of = np.searchsorted(bounds, starts, "right") - 1
        flat_a, begin_a, many_a = self.ids_a.rows(units)
        flat_b, begin_b, many_b = self.ids_b.rows(units)
        odd = (many_b == 1) & (flat_b[begin_b] < 0) if len(flat_b) else np.zeros(0, bool)
        failed = np.zeros(len(bounds) - 1, bool)
        if odd.any():
            failed[text_of[odd[codes]]] = True
            good = ~failed[text_of]
            codes, text_of = codes[good], text_of[good]
        n_texts = len(bounds) - 1
        ids_a = flat_a[ranges(begin_a[codes], many_a[codes])].astype(np.int64)
        ids_b = flat_b[ranges(begin_b[codes], many_b[codes])].astype(np.int64)
        of_a, of_b = np.repeat(text_of, many_a[codes]), np.repeat(text_of, many_b[codes])
        end_a, end_b = np.cumsum(self.bytes_a[ids_a]), np.cumsum(self.bytes_b[ids_b])
        group_a, group_b = self.chains(end_a, end_b)
        last_b = np.flatnonzero(group_b == np.arange(len(ids_b)))
        last_a = np.flatnonzero(np.r_[group_a[1:] != group_a[:-1], True][: len(ids_a)])
        # In the written form A's tokens of a group come before B's.
        number_a = np.searchsorted(last_b, group_a)
        number_b = np.searchsorted(last_b, group_b)
        b_before = np.r_[0, last_b + 1]
        a_before = np.r_[0, last_a + 1]
        place_a = np.arange(len(ids_a)) + b_before[number_a]
        place_b = np.arange(len(ids_b)) + a_before[number_b + 1]
        sign = np.empty(len(ids_a) + len(ids_b), np.int64)
        sign[place_a], sign[place_b] = ids_a, ids_b
        sign[place_a[last_a]] += self.numbers
        sign[place_b[last_b]] += 2 * self.numbers
        written = self.written.take(pa.array(sign))
        offsets = np.frombuffer(written.buffers()[1], np.int64)[written.offset :]
        counts = {
            "n_a": np.bincount(of_a, minlength=n_texts),
            "n_b": np.bincount(of_b, minlength=n_texts),
            "n_groups": np.bincount(of_b[last_b], minlength=n_texts),
        }
        tokens = np.r_[0, np.cumsum(counts["n_a"] + counts["n_b"])]
        return {
            **counts,
            "links": np.stack([ids_a[last_a], ids_b[last_b]], 1).astype(np.int32),
            "written": written.buffers()[2],
            "begins": offsets[tokens] if len(sign) else np.zeros(n_texts + 1, np.int64),
            "failed": failed,
        }


_PAIRS: dict[tuple, Pair] = {}


class _Sums:
    """Counts of linked pairs of ids, in one number each."""

    def __init__(self):
        self.codes, self.counts, self.held = [], [], 0

    def add(self, links: np.ndarray) -> None:
        code = links[:, 0].astype(np.int64) << 32 | links[:, 1]
        codes, counts = np.unique(code, return_counts=True)
        self.codes.append(codes)
        self.counts.append(counts)
        self.held += len(codes)
        if self.held > PAIRS_HELD:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.codes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes, place = np.unique(np.concatenate(self.codes), return_inverse=True)
        counts = np.zeros(len(codes), np.int64)
        np.add.at(counts, place, np.concatenate(self.counts))
        self.codes, self.counts, self.held = [codes], [counts], 0
        return codes, counts


def _stretches(data: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """One text in stretches of whole units."""
    starts = np.append(unit_starts(data, np.array([0, len(data)])), len(data))
    at = 0
    while at < len(data):
        later = starts[np.searchsorted(starts, at + most) :]
        end = int(later[0]) if len(later) else len(data)
        yield data[at:end]
        at = end


def _short(pair: Pair, data: np.ndarray, bounds: np.ndarray, sums: _Sums) -> dict:
    """Outputs of texts of moderate length."""
    found = pair.aligned(data, bounds)
    sums.add(found["links"])
    begins, written = found["begins"].tolist(), found["written"]
    sha = [
        hashlib.sha256(written[a : b - 1]).hexdigest() if b > a else ""
        for a, b in zip(begins[:-1], begins[1:])
    ]
    offsets = (8 * np.r_[0, np.cumsum(found["n_groups"])]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(found["links"])]
    links = pa.Array.from_buffers(pa.binary(), len(sha), buffers)
    return {name: found[name] for name in _SUMS[:3]} | {"sha": sha, "links": links}


def _long(pair: Pair, data: np.ndarray, sums: _Sums) -> dict:
    """Outputs of one long text, handled in stretches."""
    digest, parts, total = hashlib.sha256(), [], dict.fromkeys(_SUMS[:3], 0)
    for stretch in _stretches(data, STRETCH_BYTES):
        found = pair.aligned(stretch, np.array([0, len(stretch)]))
        if found["failed"][0]:
            total = {name: [0] for name in total}
            return total | {"sha": [""], "links": pa.array([b""], pa.binary())}
        if parts:
            digest.update(b";")
        digest.update(found["written"][: int(found["begins"][1]) - 1])
        parts.append(found["links"])
        for name in total:
            total[name] += int(found[name][0])
    for part in parts:
        sums.add(part)
    links = pa.array([b"".join(p.tobytes() for p in parts)], pa.binary())
    return {n: [t] for n, t in total.items()} | {"sha": [digest.hexdigest()], "links": links}


def _rows(pair: Pair, texts: pa.Array, sums: _Sums) -> Iterator[tuple[int, int, dict]]:
    """Outputs of a batch's texts, by the first and last of them; a long one goes alone."""
    data, bounds = spaced(texts)
    long = np.flatnonzero(np.diff(bounds) > STRETCH_BYTES)
    cuts = np.unique(np.r_[0, long, long + 1, len(texts)]).tolist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        part, inside = data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
        if b - a == 1 and len(part) > STRETCH_BYTES:
            found = _long(pair, part, sums)
        else:
            found = _short(pair, part, inside, sums)
        columns = {name: pa.array(found[name], pa.int64()) for name in _SUMS[:3]}
        columns |= {"n_links": columns["n_groups"], "links": found["links"]}
        yield a, b, columns | {"groups_sha256": pa.array(found["sha"], pa.string())}


def _align_task(
    batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    key = (path_a, path_b)
    if key not in _PAIRS:
        _PAIRS[key] = Pair(path_a, path_b)
    sums = _Sums()

    def record(columns: dict, n: int) -> pa.RecordBatch:
        arrays = [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema]
        return pa.RecordBatch.from_arrays(
            [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, schema)],
            schema=schema,
        )

    for batch in text_batches(batches, "text", STRETCH_BYTES):
        for a, b, columns in _rows(_PAIRS[key], batch.column("text"), sums):
            yield record(columns | {"row": batch.column("row").slice(a, b - a)}, b - a)
    codes, counts = sums.total()
    yield record({"code": pa.array(codes), "times": pa.array(counts)}, len(codes))


def _look_up(batches: Iterator[pa.RecordBatch], table) -> Iterator[pa.RecordBatch]:
    codes, times, best = table.value
    for batch in batches:
        links = batch.column("links")
        sizes = pc.binary_length(links).to_numpy() // 8
        raw = b"".join(links.to_pylist())
        flat = np.frombuffer(raw, np.int32).reshape(-1, 2) if raw else np.zeros((0, 2), np.int32)
        place = np.searchsorted(codes, flat[:, 0].astype(np.int64) << 32 | flat[:, 1])
        cuts = np.r_[0, np.cumsum(sizes)]
        run_times = np.r_[0, np.cumsum(times[place])][cuts]
        run_best = np.r_[0, np.cumsum(best[place])][cuts]
        names = [n for n in batch.schema.names if n != "links"]
        columns = [batch.column(n) for n in names]
        added = [pa.array(np.diff(run_best), pa.int64()), pa.array(np.diff(run_times), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns + added, names=[*names, "n_best", "count_sum"])


def align(
    docs: DataFrame, path_a: str, path_b: str, keep: list[str] | None = None
) -> DataFrame:
    """``docs``, or its columns ``keep``, with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    ``path_a`` is the file of a byte-level tokenizer, ``path_b`` of a piece tokenizer with byte
    fallback; tasks must be able to open both.
    """
    spark = docs.sparkSession
    kept = [c for c in (docs.columns if keep is None else keep) if c not in _OUTPUT]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), "text")
    spelled = rows.schema["row"].dataType.simpleString()
    schema = f"row {spelled}, {_DOCUMENT}, code long, times long"
    arrow = _arrow_schema(spark, schema)
    found = stored(map_arrow(rows, _align_task, schema, path_a, path_b, arrow), "aligned")
    pairs = found.where("code IS NOT NULL").groupBy("code").agg(F.sum("times").alias("times"))
    most = F.max("times").over(_by_b())
    table = pairs.select("code", "times", (F.col("times") == most).cast("long").alias("best"))
    held = table.toArrow().sort_by("code")
    if len(held) > pair_bound(path_a, path_b):
        raise ValueError("more linked pairs than two vocabularies can have")
    sent = spark.sparkContext.broadcast(tuple(held[c].to_numpy() for c in ("code", "times", "best")))
    documents = found.where("code IS NULL AND n_a IS NOT NULL").drop("code", "times")
    sums = ", ".join(f"{c} long" for c in _SUMS)
    out = map_arrow(
        documents,
        _look_up,
        f"row {spelled}, {sums}, groups_sha256 string, n_best long, count_sum long",
        sent,
    )
    return out.select(*[F.col(f"row.`{c}`") for c in kept], *_OUTPUT)


def _by_b():
    from pyspark.sql.window import Window

    return Window.partitionBy(F.col("code").bitwiseAND(F.lit((1 << 32) - 1)))


def _arrow_schema(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def pair_bound(path_a: str, path_b: str) -> int:
    """Pairs of ids of which one spells an end of the other: not more than both have bytes,
    twice, since B may spell a byte in two ways."""
    pair = _PAIRS.get((path_a, path_b)) or Pair(path_a, path_b)
    return 2 * int(pair.bytes_a.sum() + pair.bytes_b.sum())
