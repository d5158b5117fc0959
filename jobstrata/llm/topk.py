"""Exact top-k inner products by aggregation of sorted lists without random access.

Every component is a list of a block's rows in order of their value. A query reads each list
from the end that its own component favours, all lists to the same depth, in growing steps. A
step adds what is newly read to a running sum per row. That sum and what unread values can be,
at worst the list's other end and at best the next value of the list, give each row a lower and
an upper bound. Rows whose upper bound is below the k-th lower bound cannot qualify and are left
out of further steps. A query stops when outsiders can't qualify, so that few rows are left, and
the scores of these are resolved. At the full depth the running sums are the scores. A tile of queries reads its lists
together, so each step is a product of matrices that hold only what is newly read. Values are
whole numbers and all arithmetic is exact.

Defined cases: vectors that are null, empty or hold null or non-finite components take no
part, nor do rows without an id; ties go to the smaller id; a query's own id is no candidate;
repeated rows count as often as they occur; only vectors of equal length are compared; scores
beyond 64 bits stop at the end of the range; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.blocks import first_in_rows, nearest, vectors

# Depths to which lists are read before bounds are looked at, as shares of their length.
DEPTHS = (1 / 8, 1 / 4, 1 / 2, 3 / 4, 7 / 8, 15 / 16, 1)
# So many rows, as a share, are few enough to be resolved instead of read on for.
FEW = 1 / 32
TILE = 512


def _number_type(queries: np.ndarray, rows: np.ndarray):
    """The fastest type in which sums of products are exact."""
    largest = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * queries.shape[1]
    return np.float32 if largest < 2**23 else np.float64 if largest < 2**52 else object


class _Lists:
    """Sorted lists of a block and what is read of them, shared by all queries."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.ordered = np.sort(rows, axis=0)
        self.most, self.least = self.ordered[-1], self.ordered[0]
        self.steps: dict[float, tuple] = {}

    def read(self, depth: float) -> tuple[np.ndarray, ...]:
        """The last value read from the upper and from the lower end of each list, and which
        rows are read from either; with a value all that equal it are read."""
        if depth not in self.steps:
            last = min(len(self.rows), int(np.ceil(depth * len(self.rows)))) - 1
            high, low = self.ordered[-1 - last], self.ordered[last]
            self.steps[depth] = high, low, self.rows >= high, self.rows <= low
        return self.steps[depth]


def _read(lists: _Lists, queries: np.ndarray, own: np.ndarray, limit: int, rounded: bool):
    """Per query of a tile: the rows left when it stopped, their scores, and the depth."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    kind = queries.dtype
    alive = np.arange(len(lists.rows))
    reading = np.arange(len(queries))
    sums = np.zeros((len(queries), len(alive)), kind)
    was_above = was_below = np.zeros((1, queries.shape[1]), bool)
    few = max(limit, FEW * len(lists.rows))
    for depth in DEPTHS:
        high, low, above, below = lists.read(depth)
        rows = lists.rows
        if len(alive) < len(rows):
            rows, above, below = rows[alive], above[alive], below[alive]
        u, d = up[reading], down[reading]
        sums = sums + u @ (rows * (above & ~was_above)).T + d @ (rows * (below & ~was_below)).T
        other = ~own[np.ix_(reading, alive)]
        open_rows = other
        if len(alive) > limit:
            lower = sums
            if depth < 1:
                unread_above, unread_below = (~above).astype(kind).T, (~below).astype(kind).T
                lower = sums + (u * lists.least) @ unread_above + (d * lists.most) @ unread_below
            told = lower.astype(np.float64) if rounded else lower
            ranked = np.where(other, told, told.dtype.type(-np.inf))
            border = np.partition(ranked, -limit, axis=1)[:, -limit]
            if rounded:
                # Sums beyond this type's exact range were rounded.
                border -= np.abs(border) * 1e-12
            if depth < 1:
                # Unread whole numbers lie beyond the last one read. While rows that were not
                # read at all can qualify, bounds of the others are not worth a look.
                beyond = (u * (high - 1)).sum(1) + (d * (low + 1)).sum(1)
                told = np.flatnonzero((beyond < border).astype(bool))
                upper = (u[told] * (high - 1)) @ unread_above + (d[told] * (low + 1)) @ unread_below
                upper = upper + sums[told]
                open_rows = other.copy()
                open_rows[told] &= (upper >= border[told, None]).astype(bool)
            else:
                open_rows = other & (sums >= border[:, None]).astype(bool)
        done = (open_rows.sum(1) <= few) | (depth == 1)
        for at in np.flatnonzero(done).tolist():
            left = np.flatnonzero(open_rows[at])
            yield int(reading[at]), alive[left], sums[at, left] if depth == 1 else None, depth
        reading, sums, open_rows = reading[~done], sums[~done], open_rows[~done]
        if not len(reading):
            return
        kept = open_rows.any(0)
        if kept.sum() <= 0.9 * len(kept):
            alive, sums, above, below = alive[kept], sums[:, kept], above[kept], below[kept]
        was_above, was_below = above, below


def _block(limit: int):
    def work(query_ids, queries, row_ids, rows):
        scaled_queries, scaled_rows = np.floor(64 * queries), np.floor(64 * rows)
        kind = _number_type(scaled_queries, scaled_rows)
        if kind is object:
            exact = np.vectorize(int, otypes=[object])
            scaled_queries, scaled_rows = exact(scaled_queries), exact(scaled_rows)
        all_queries, all_rows = scaled_queries.astype(kind), scaled_rows.astype(kind)
        none = np.zeros(0, np.int64)
        found = [(none, none, none, np.zeros(0))]
        lists = _Lists(all_rows) if len(all_rows) else None
        for start in range(0, len(all_queries) if len(all_rows) else 0, TILE):
            part = all_queries[start : start + TILE]
            own = query_ids[start : start + TILE, None] == row_ids[None, :]
            for at, left, score, depth in _read(lists, part, own, limit, kind is object):
                if score is None:
                    score = (part[at] * all_rows[left]).sum(1)
                if kind is object:
                    score = [max(-(2**63), min(2**63 - 1, x)) for x in score]
                score = np.array(score).astype(np.int64)
                query = np.full(len(left), start + at)
                keep = first_in_rows(query, row_ids, left, ~score, limit)
                depths = np.full(len(keep), depth)
                found.append((query[keep], left[keep], score[keep], depths))
        return tuple(np.concatenate(c) for c in zip(*found))

    return work


def top_inner_products(
    table: DataFrame, is_query: Column, limit: int, with_depth: bool = False
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``limit`` largest inner products of
    floor(64 * component); ``is_query`` is a condition on ``id``. ``with_depth`` adds how far
    the query had read its lists in the block of the row, as a share."""
    rows = vectors(table, zero=True)
    order = [F.col("score").desc()]
    found = nearest(rows, is_query, _block(limit), limit, "long", order, "depth double")
    return found if with_depth else found.drop("depth")
