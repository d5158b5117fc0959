"""Near-duplicates by an inverted join over MinHash signatures.

1. Documents become sets of shingles (hashed), a hash of the whole set and a signature of
   ``COORDINATES`` minima. Documents with equal sets are one class from here on.
2. Every class is posted under each (coordinate, value). Lists of one are dropped; a class
   that has fewer than ``matches`` other postings cannot reach that many collisions with
   anything, and is dropped too.
3. Two classes with ``matches`` collisions meet in the list of one of the
   ``COORDINATES - matches + 1`` rarest postings of both; only these lists are merged, the
   longer ones are skipped. Collisions are counted on whole signatures, in blocks of a list,
   and of those that pass a spanning set is emitted, one row per class and list at most.
4. Components of these candidates are compared completely and exactly: full sets meet in
   blocks of a component, and of the links found again a spanning set is emitted.
5. Components of the links, spread to all members of the classes, are the result.

The threshold is an argument, and the collisions asked for follow from it (28 at 0.85, 24 at
0.80), so that two documents at it miss stage 3 with a chance below 2e-6, and less above.
Rows emitted grow with the documents, never with pairs; comparisons inside a list or
component of n classes are n * n / 2, in tasks of two blocks each.

Defined cases: texts that are null or without words have no shingles and are linked with
nothing; with fewer words than a shingle the whole sequence is one; a row without doc_id is
linked with nothing, has no component and is kept; doc_ids are taken as unique, rows that
repeat id and text share their result; texts of any length are shingled whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.common import map_arrow, mix64, ranges, stored, text_batches
from jobstrata.llm.graph import components

SHINGLE = 5
COORDINATES = 48
# The chance of a miss at the threshold that is let pass.
MISS = 2e-6
# Links: intersection * 100 >= percent * union; this unless the caller says another.
PERCENT = 85
# Classes in a block of a list or component, and shingles in a block of a component.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
_FACTORS = mix64(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_PLACES = mix64(np.arange(101, 101 + SHINGLE, dtype=np.uint64)) | np.uint64(1)

_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if b in b"\t\n\v\f\r" else b for b in range(256))


def matches_at(percent: int) -> int:
    """The most collisions that two documents at the threshold miss with a chance of ``MISS``
    at most."""
    p, missed = percent / 100, 0.0
    for n in range(COORDINATES):
        missed += comb(COORDINATES, n) * p**n * (1 - p) ** (COORDINATES - n)
        if missed > MISS:
            return max(n, 1)
    return COORDINATES


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed shingles of all texts, each text's distinct ones in rising order, and the
    numbers of them."""
    import xxhash

    texts = pc.fill_null(texts, "").cast(pa.large_string())
    # Bytes are translated in place: all six blanks to spaces, A-Z to a-z.
    _, offsets, data = texts.buffers()
    low = pa.py_buffer(data.to_pybytes().translate(_LOWER) if data else b"")
    plain = pa.Array.from_buffers(
        pa.large_string(), len(texts), [None, offsets, low], offset=texts.offset
    )
    split = pc.split_pattern(plain, " ")
    parts = split.flatten()
    owner = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    filled = pc.binary_length(parts).to_numpy() > 0
    words, owner = parts.filter(pa.array(filled)).dictionary_encode(), owner[filled]
    digest = xxhash.xxh3_64_intdigest
    distinct = words.dictionary.cast(pa.large_binary()).to_pylist()
    each = np.fromiter(map(digest, distinct), np.uint64, len(distinct))
    word = each[words.indices.to_numpy()]
    count = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(count) - count
    made = np.where(count > 0, np.maximum(count - SHINGLE + 1, 1), 0)
    starts = ranges(first, made)
    home = np.repeat(np.arange(len(texts)), made)
    end = (first + count)[home]
    value = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(SHINGLE):
            at = starts + i
            inside = at < end
            at = np.where(inside, at, 0)
            if len(word):
                value += np.where(inside, word[at] * _PLACES[i], np.uint64(0))
    value = mix64(value)
    order = np.lexsort((value, home))
    value, home = value[order], home[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (home[1:] != home[:-1])
    return value[new], np.bincount(home[new], minlength=len(texts))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches, "text", 2 << 20):
        value, count = shingle_sets(batch.column("text"))
        some = count > 0
        begin = (np.cumsum(count) - count)[some]
        signature = np.zeros((len(count), COORDINATES), np.uint32)
        whole = np.zeros((2, len(count)), np.uint64)
        with np.errstate(over="ignore"):
            if len(begin):
                for i, factor in enumerate(_FACTORS):
                    least = np.minimum.reduceat(value * factor, begin)
                    signature[some, i] = (least >> np.uint64(32)).astype(np.uint32)
                whole[0, some] = np.add.reduceat(mix64(value), begin)
                whole[1, some] = np.add.reduceat(mix64(value + np.uint64(1)), begin)
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "n_shingles": pa.array(count.astype(np.int64)),
                "set_a": pa.array(whole[0].view(np.int64)),
                "set_b": pa.array(whole[1].view(np.int64)),
                "signature": pa.FixedSizeListArray.from_arrays(
                    pa.array(signature.reshape(-1).view(np.int32)), COORDINATES
                ).cast(pa.list_(pa.int32())),
            }
        )


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        columns = [batch.column(k).to_numpy() for k in keys]
        changed = np.zeros(batch.num_rows, bool)
        for column in columns:
            changed[1:] |= column[1:] != column[:-1]
        if held:
            changed[0] = any(
                held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys
            )
        cuts = np.flatnonzero(changed)
        if not len(cuts):
            held.append(batch)
            continue
        last = int(cuts[-1])
        done = pa.Table.from_batches([*held, batch.slice(0, last)])
        if done.num_rows:
            yield done.combine_chunks()
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where groups begin, and the end."""
    changed = np.zeros(table.num_rows, bool)
    changed[:1] = True
    for k in keys:
        column = table[k].to_numpy()
        changed[1:] |= column[1:] != column[:-1]
    return np.r_[np.flatnonzero(changed), table.num_rows]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` reaches over the pairs."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _spanning(nodes: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    moved = np.flatnonzero(label != np.arange(len(label)))
    return pa.record_batch(
        {"a": pa.array(nodes[moved], pa.int64()), "b": pa.array(nodes[label[moved]], pa.int64())}
    )


def _colliding(matches: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ["list", "block_a", "block_b"]
    for table in _groups(batches, keys):
        bounds = _bounds(table, keys)
        nodes = table["node"].to_numpy()
        posted = table["keys"].combine_chunks() if table.num_rows else None
        flat = posted.flatten().to_numpy()
        row = np.repeat(np.arange(len(nodes)), np.diff(posted.offsets.to_numpy()))
        # Singles differ from anything, also from one another.
        grid = np.full((len(nodes), COORDINATES), -1, np.int64)
        grid[row, flat >> 32] = flat & 0xFFFFFFFF
        sizes = np.diff(bounds)
        end = np.repeat(bounds[1:], sizes)
        here = np.arange(len(nodes))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        # Rows are taken so many at a time that pairs stay within a few megabytes.
        steps = np.cumsum(end - here - 1) // 100_000
        cuts = np.r_[0, np.flatnonzero(np.diff(steps)) + 1, len(here)]
        for x, y in zip(cuts[:-1], cuts[1:]):
            lengths = (end - here - 1)[x:y]
            a = np.repeat(here[x:y], lengths)
            b = ranges(here[x:y] + 1, lengths)
            same = np.zeros(len(a), np.int16)
            for column in grid.T:
                left = column[a]
                same += (left == column[b]) & (left >= 0)
            near = same >= matches
            found.append((a[near], b[near]))
        a, b = (np.concatenate(c) for c in zip(*found)) if found else (here[:0], here[:0])
        yield _spanning(nodes, _roots(len(nodes), a, b))


def _blocked(rows: DataFrame, key: str, blocks) -> DataFrame:
    """Rows dealt to the pairs of blocks of their group, sorted by group and pair."""
    own = F.pmod(F.xxhash64("node"), F.col("__blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__blocks") - 1))
    names = rows.columns
    counted = rows.withColumn("__blocks", blocks.cast("long"))
    dealt = counted.select(*names, own.alias("__own"), "__blocks")
    paired = dealt.select(*names, "__own", other.alias("__other")).select(
        *names,
        F.least("__own", "__other").alias("block_a"),
        F.greatest("__own", "__other").alias("block_b"),
    )
    return paired.repartition(key, "block_a", "block_b").sortWithinPartitions(
        key, "block_a", "block_b", "node"
    )


def candidates(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) that connect all classes with enough collisions."""
    matches = matches_at(percent)
    posted = classes.select("node", F.posexplode("signature").alias("place", "value")).select(
        "node",
        F.shiftleft(F.col("place").cast("long"), 32)
        .bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
        .alias("key"),
    )
    lists = posted.groupBy("key").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    shared = (
        posted.join(lists, "key")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("length", "key"))).alias("lists"))
        .where(F.size("lists") >= matches)
    )
    shared = stored(shared, "postings")
    # Rarest first: of the postings that can matter, all but the last matches - 1.
    prefix = F.slice("lists", F.lit(1), F.size("lists") - matches + 1)
    keys = F.transform("lists", lambda x: x["key"]).alias("keys")
    posted = shared.select("node", F.explode(prefix).alias("at"), keys)
    rows = posted.select(
        "node", F.col("at.key").alias("list"), F.col("at.length").alias("length"), "keys"
    )
    dealt = _blocked(rows, "list", F.ceil(F.col("length") / BLOCK)).drop("length")
    return map_arrow(dealt, partial(_colliding, matches), "a long, b long")


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches, "text", 2 << 20):
        value, count = shingle_sets(batch.column("text"))
        ends = np.cumsum(count)
        raw = value.tobytes()
        sets = [raw[8 * (e - n) : 8 * e] for e, n in zip(ends.tolist(), count.tolist())]
        yield pa.record_batch(
            {
                "node": batch.column("node"),
                "part": batch.column("part"),
                "blocks": batch.column("blocks"),
                "shingles": pa.array(sets, pa.binary()),
            }
        )


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of slices of the incidence matrix."""
    value = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(value, kind="stable")
    value, row = value[order], row[order]
    column = np.cumsum(np.r_[False, value[1:] != value[:-1]])
    shared = np.bincount(column)[column] > 1
    column, row = column[shared], row[shared]
    common = np.zeros((len(sets), len(sets)), np.float32)
    if len(column):
        column = np.cumsum(np.r_[False, column[1:] != column[:-1]])
    width = 2048
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        x, y = np.searchsorted(column, (at, at + width))
        part = np.zeros((len(sets), width), np.float32)
        part[row[x:y], column[x:y] - at] = 1
        common += part @ part.T
    return common


def _linked(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ["part", "block_a", "block_b"]
    for table in _groups(batches, keys):
        bounds = _bounds(table, keys)
        nodes = table["node"].to_numpy()
        for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if y - x < 2:
                continue
            raw = table["shingles"].slice(x, y - x).to_pylist()
            sets = [np.frombuffer(s, np.uint64) for s in raw]
            size = np.array([len(s) for s in sets], np.float64)
            common = _overlaps(sets)
            pairs = []
            for i in range(len(sets) - 1):
                both = common[i, i + 1 :].astype(np.float64)
                near = 100 * both >= percent * (size[i] + size[i + 1 :] - both)
                pairs.append(np.flatnonzero(near) + i + 1)
            a = np.repeat(np.arange(len(pairs)), [len(p) for p in pairs])
            b = np.concatenate(pairs)
            if len(a):
                yield _spanning(nodes[x:y], _roots(y - x, a, b))


def links(
    docs: DataFrame, parts: DataFrame, sizes: DataFrame, percent: int = PERCENT
) -> DataFrame:
    """Pairs (a, b) that connect all linked classes; ``parts`` has the candidates' components
    (node, root), ``sizes`` the number of shingles per node."""
    sized = parts.join(sizes, "node").select("node", F.col("root").alias("part"), "n_shingles")
    totals = sized.groupBy("part").agg(
        F.count(F.lit(1)).alias("nodes"), F.sum("n_shingles").alias("total")
    )
    blocks = F.greatest(F.ceil(F.col("nodes") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES))
    wanted = sized.join(totals, "part").select("node", "part", blocks.alias("blocks"))
    wanted = stored(wanted, "parts")
    text = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    # An id that repeats brings its texts into the same comparison.
    sets = map_arrow(
        text.join(wanted, "node"),
        _shingled,
        "node long, part long, blocks long, shingles binary",
    )
    dealt = _blocked(sets, "part", F.col("blocks")).drop("blocks")
    return map_arrow(dealt, partial(_linked, percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document, linked from a Jaccard
    similarity of ``percent`` hundredths on."""
    signed = stored(
        map_arrow(
            docs.select("doc_id", "text"),
            _sign,
            "doc_id long, n_shingles long, set_a long, set_b long, signature array<int>",
        ),
        "signatures",
    )
    identity = ["set_a", "set_b", "n_shingles"]
    some = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(
        some.groupBy(*identity, "signature").agg(F.min("doc_id").alias("node")), "classes"
    )
    parts = stored(components(candidates(classes, percent)), "candidates")
    sizes = classes.groupBy("node").agg(F.max("n_shingles").alias("n_shingles"))
    roots = stored(components(links(docs, parts, sizes, percent)), "roots")
    placed = classes.select(*identity, "node").join(roots, "node", "left")
    member = placed.select(
        *[F.col(c).alias(f"_{c}") for c in identity], F.coalesce("root", "node").alias("root")
    )
    same = [F.col(c) == F.col(f"_{c}") for c in identity]
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return (
        signed.drop("signature")
        .join(member, same, "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
