"""Quantile sketches per group: small, mergeable, and right within a stated rank error.

Dashboards that can do without exact medians keep one sketch per group and part of a table, and
merge those that a view asks for. A sketch of size ``SKETCH_SIZE`` holds some thousand values,
however many it has seen. A quantile from it is a value whose rank among the group's values
is off by at most ``RANK_ERROR`` of their number; the published error of such a sketch is less
than half of that with a certainty of 99 %, and merging does not add to it. Groups of up
to ``SKETCH_SIZE`` values are exact but for interpolation. The exact way is
``percentiles.grouped_percentiles``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_SIZE = 1000
RANK_ERROR = 0.01


def value_sketches(
    df: DataFrame, keys: Sequence[str], value: Column, size: int = SKETCH_SIZE
) -> DataFrame:
    """keys, sketch and n, the number of values, of every group; a sketch of none is null."""
    finite = F.when(~F.isnan(value), value)
    return (
        df.groupBy(*keys)
        .agg(F.kll_sketch_agg_double(finite, size).alias("sketch"), F.count(finite).alias("n"))
        .withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))
    )


def merged_sketches(
    parts: DataFrame, keys: Sequence[str], size: int = SKETCH_SIZE
) -> DataFrame:
    """The sketches of parts of a table as those of the whole, by coarser or the same keys."""
    return parts.groupBy(*keys).agg(
        F.when(F.sum("n") > 0, F.kll_merge_agg_double("sketch", size)).alias("sketch"),
        F.sum("n").alias("n"),
    )


def quantiles(
    sketches: DataFrame, keys: Sequence[str], fractions: Mapping[str, float]
) -> DataFrame:
    """keys, n, and one quantile per entry of ``fractions``; null where there are no values."""
    return sketches.select(
        *keys,
        "n",
        *[
            F.when(
                F.col("n") > 0,
                F.kll_sketch_get_quantile_double("sketch", F.lit(float(fraction))),
            ).alias(name)
            for name, fraction in fractions.items()
        ],
    )


def within_error(
    df: DataFrame,
    found: DataFrame,
    keys: Sequence[str],
    value: Column,
    name: str,
    fraction: float,
    error: float = RANK_ERROR,
) -> DataFrame:
    """keys, n and whether the quantile ``name`` of ``found`` has a rank within ``error`` of
    ``fraction``, told by all values; a group without values has no quantile to be wrong."""
    told = found.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("n"), F.col(name).alias("_q"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    rows = df.withColumn("_v", value).join(told, same)
    low, high = F.count(F.when(F.col("_v") < F.col("_q"), 1)), F.count(
        F.when(F.col("_v") <= F.col("_q"), 1)
    )
    # One rank more, as the wanted rank may lie between two values.
    slack = error * F.max("n") + 1
    wanted = fraction * F.max("n")
    return rows.groupBy(*keys).agg(
        F.max("n").alias("n"),
        ((F.max("n") == 0) | ((low <= wanted + slack) & (high >= wanted - slack))).alias("within"),
    )
