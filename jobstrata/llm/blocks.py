"""Pairs of a block of queries with a block of candidates, each met in one task.

Both sides are dealt to blocks by a hash of their ids, and every query block goes to every
candidate block: a join in blocks of a stated query set against all rows, whose tasks hold
two blocks however many there are. Only vectors of equal length meet.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUERY_BLOCK = 8192
ROW_BLOCK = 16384
_SIDES = "dim int, query_block long, row_block long, is_query boolean, id long, vec array<double>"


def usable(vector: Column, zero: bool) -> Column:
    """Whether a vector has components and all are finite numbers; ``zero``: may be zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.size(vector) > 0
    if not zero:
        some &= F.exists(vector, lambda x: x != 0)
    return F.coalesce(good & some, F.lit(False))


def vectors(table: DataFrame, zero: bool) -> DataFrame:
    """id, vec and dim of the rows that take part; rows without an id don't."""
    vec = F.col("embedding")
    return table.where(F.col("vec_id").isNotNull() & usable(vec, zero)).select(
        F.col("vec_id").cast("long").alias("id"),
        vec.cast("array<double>").alias("vec"),
        F.size(vec).alias("dim"),
    )


def nearest(
    rows: DataFrame,
    is_query: Column,
    work: Callable,
    limit: int,
    score: str,
    order: list[Column],
    more: str = "",
) -> DataFrame:
    """Each query's ``limit`` first rows by ``order``: query_id, rank, vec_id, score.

    ``work`` gets the ids and vectors of a query block and of a row block and returns the
    indices of queries and rows that may be among the first, with their scores and, if ``more``
    names it and its type, a further column. Rows that
    repeat count as often as they occur; of queries with one id the smallest vector counts.
    """
    numbers = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(is_query, 1)).alias("queries")
    ).first()
    query_blocks = max(1, -(-numbers["queries"] // QUERY_BLOCK))
    row_blocks = max(1, -(-numbers["rows"] // ROW_BLOCK))

    def dealt(side: DataFrame, own: str, n: int, other: str, m: int, flag: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.lit(n)).alias(own)
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias(other)
        return side.select("dim", "id", "vec", block, every).select(
            "dim", "query_block", "row_block", F.lit(flag).alias("is_query"), "id", "vec"
        )

    queries = rows.where(is_query).groupBy("id", "dim").agg(F.min("vec").alias("vec"))
    sides = dealt(queries, "query_block", query_blocks, "row_block", row_blocks, True).unionByName(
        dealt(rows, "row_block", row_blocks, "query_block", query_blocks, False)
    )

    names = [more.split()[0]] if more else []

    def run(table: pa.Table) -> pa.Table:
        flags = table["is_query"].to_numpy()
        ids = table["id"].to_numpy()
        dim = table["dim"][0].as_py()
        flat = table["vec"].combine_chunks().flatten().to_numpy()
        matrix = flat.reshape(-1, dim)
        query, row, value, *added = work(ids[flags], matrix[flags], ids[~flags], matrix[~flags])
        return pa.table(
            {
                "query_id": pa.array(ids[flags][query], pa.int64()),
                "vec_id": pa.array(ids[~flags][row], pa.int64()),
                "score": pa.array(value),
                **{name: pa.array(column) for name, column in zip(names, added, strict=True)},
            }
        )

    schema = f"query_id long, vec_id long, score {score}" + (f", {more}" if more else "")
    found = sides.groupBy("dim", "query_block", "row_block").applyInArrow(run, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order, "vec_id"))
    ranked = found.select("query_id", rank.alias("rank"), "vec_id", "score", *names)
    return ranked.where(F.col("rank") <= limit)


def first_in_rows(
    query: np.ndarray, row_ids: np.ndarray, row: np.ndarray, value: np.ndarray, limit: int
) -> np.ndarray:
    """Positions of each query's ``limit`` smallest values, ties to the smaller row id."""
    order = np.lexsort((row_ids[row], value, query))
    starts = np.flatnonzero(np.r_[True, np.diff(query[order]) != 0]) if len(order) else order
    lengths = np.diff(np.r_[starts, len(order)])
    place = np.arange(len(order)) - np.repeat(starts, lengths)
    return order[place < limit]
