"""Fingerprints of what a table holds, whatever the order of its rows.

A fingerprint is the number of rows and two sums of row hashes. Every value goes into its row's
hash at its position and apart from null, so exchanged columns, changed values and rows that
are lost or doubled all show, where counts do not. Sums are exact and combine before
any shuffle, and they can be taken by an observation while the rows are being written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Fingerprint(NamedTuple):
    rows: int
    first: int
    second: int


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    # A null leaves the hash as it is, so whether a value is null goes in as well.
    parts = [p for c in columns for p in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *parts)


def _aggregates(columns: Sequence[str]) -> list[Column]:
    sums = [
        F.coalesce(F.sum(_row_hash(columns, seed).cast("decimal(28,0)")), F.lit(0)).alias(name)
        for seed, name in ((1, "first"), (2, "second"))
    ]
    return [F.count(F.lit(1)).alias("rows"), *sums]


def fingerprint(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """rows, first and second of ``df``, or of each group; columns count in their order."""
    return df.groupBy(*by).agg(*_aggregates(df.columns))


def fingerprint_of(df: DataFrame) -> Fingerprint:
    row = fingerprint(df).first()
    return Fingerprint(row["rows"], int(row["first"]), int(row["second"]))


def watched(df: DataFrame) -> tuple[DataFrame, Callable[[], Fingerprint]]:
    """``df`` to be written once, and its fingerprint, which the write itself takes."""
    seen = Observation()

    def taken() -> Fingerprint:
        found = seen.get
        return Fingerprint(found["rows"], int(found["first"]), int(found["second"]))

    return df.observe(seen, *_aggregates(df.columns)), taken


def comparison(source: DataFrame, sink: DataFrame) -> DataFrame:
    """One row: rows of both, whether their numbers agree, and whether their contents do."""
    given = fingerprint(source).select(*[F.col(c).alias(f"source_{c}") for c in Fingerprint._fields])
    found = fingerprint(sink).select(*[F.col(c).alias(f"sink_{c}") for c in Fingerprint._fields])
    same = [F.col(f"source_{c}") == F.col(f"sink_{c}") for c in Fingerprint._fields]
    # One row each, so the join is of one row with one.
    return given.withColumn("_one", F.lit(1)).join(found.withColumn("_one", F.lit(1)), "_one").select(
        "source_rows",
        "sink_rows",
        same[0].alias("counts_match"),
        (same[0] & same[1] & same[2]).alias("contents_match"),
    )
