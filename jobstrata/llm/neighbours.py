"""Nearest neighbours by a block matrix join over int8 vectors.

Vectors are rounded to int8 with a scale of their own; the length of what rounding took away
is kept. Tiles of the product of two int8 blocks give the distance of the rounded vectors,
which by the triangle inequality is off by at most the sum of the two lengths. Pairs whose
lower bound is not above the k-th upper bound are computed again from the original vectors in
double precision and kept in a heap per query. The result is exact.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take
no part, nor do rows without an id; ties go to the smaller id; a query's own id is no
candidate; repeated rows count as often as they occur; only vectors of equal length are
compared; distances whose squares are beyond a double are infinite, and so ties; other columns
are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.blocks import nearest, vectors

QUERY_TILE, ROW_TILE = 256, 4096


def _quantised(x: np.ndarray):
    """int8 components (as exact floats), scales, squared lengths and rounding errors."""
    scale = np.maximum(np.abs(x).max(1, initial=0) / 127, np.finfo(float).tiny)
    small = np.rint(x / scale[:, None]).astype(np.int8)
    near = small * scale[:, None]
    error = np.sqrt(((x - near) ** 2).sum(1))
    size = np.sqrt((near * near).sum(1))
    # Rounding of the arithmetic itself is far below this.
    return small, scale, size, error + 1e-7 * size


def _exact(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distances; a row-major array of components by rows is added up in order."""
    gap = np.ascontiguousarray(rows.T) - query[:, None]
    return np.sqrt(np.add.reduce(gap * gap, axis=0))


def _block(limit: int):
    def compute(query_ids, queries, row_ids, rows):
        small_q, scale_q, size_q, error_q = _quantised(queries)
        small_r, scale_r, size_r, error_r = _quantised(rows)
        # Products of int8 sum exactly in this type.
        kind = np.float32 if queries.shape[1] < 1000 else np.float64
        heaps: list[list[tuple]] = [[] for _ in query_ids]
        for a in range(0, len(query_ids), QUERY_TILE):
            q = slice(a, a + QUERY_TILE)
            for b in range(0, len(row_ids), ROW_TILE):
                r = slice(b, b + ROW_TILE)
                dot = small_q[q].astype(kind) @ small_r[r].astype(kind).T
                square = dot.astype(np.float64)
                square *= -2 * scale_q[q, None] * scale_r[None, r]
                square += (size_q[q] ** 2)[:, None]
                square += (size_r[r] ** 2)[None, :]
                # Near 0 the root magnifies rounding; this stays above it.
                slack = 1e-13 * (size_q[q].max() + size_r[r].max()) ** 2
                spread = error_q[q, None] + error_r[None, r]
                upper = np.sqrt(np.maximum(square, 0) + slack) + spread
                lower = np.sqrt(np.maximum(square - slack, 0)) - spread
                # Squares beyond this type's range bound nothing.
                lower[np.isnan(lower)], upper[np.isnan(upper)] = -np.inf, np.inf
                own = query_ids[q, None] == row_ids[None, r]
                upper[own] = np.inf
                for i in range(len(upper)):
                    heap = heaps[a + i]
                    border = np.inf
                    if upper.shape[1] > limit:
                        border = np.partition(upper[i], limit - 1)[limit - 1]
                    if len(heap) == limit:
                        border = min(border, heap[-1][0])
                    near = np.flatnonzero((lower[i] <= border) & ~own[i])
                    if not len(near):
                        continue
                    distance = _exact(queries[a + i], rows[b + near])
                    new = zip(distance.tolist(), row_ids[b + near].tolist(), (b + near).tolist())
                    heaps[a + i] = heapq.nsmallest(limit, [*heap, *new])
        query = np.repeat(np.arange(len(heaps)), [len(h) for h in heaps])
        row = np.array([x[2] for h in heaps for x in h], np.int64)
        score = np.array([x[0] for h in heaps for x in h], np.float64)
        return query, row, score

    def work(*sides):
        with np.errstate(over="ignore", invalid="ignore"):
            return compute(*sides)

    return work


def nearest_neighbours(table: DataFrame, is_query: Column, limit: int) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of each query's ``limit``
    nearest rows; ``is_query`` is a condition on ``id``."""
    rows = vectors(table, zero=False)
    return nearest(rows, is_query, _block(limit), limit, "double", [F.col("score")])
