"""Helpers shared by the operators: tables, stored steps, batches, words and letters."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata.workspace import new_path

# A word as the contracts define it: a run of anything but these six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
# Text handled at once inside a task; one longer text is a batch of its own.
BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once into the shared work folder and read it back: later steps start
    from files that outlive any executor."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def as_row(docs: DataFrame) -> Column:
    """All columns as one struct, so that a step's own columns can't clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """A column, or, written with a dot, a field of a struct column."""
    name, _, field = column.partition(".")
    return batch.column(name).field(field) if field else batch.column(name)


def text_batches(
    batches: Iterator[pa.RecordBatch],
    column: str,
    limit: int = BATCH_BYTES,
    rows: int | None = None,
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``, as for ``texts_of``, and
    of at most ``rows`` rows."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(texts_of(batch, column)), 0).to_numpy(False)
        group = np.cumsum(sizes, dtype=np.int64) // limit
        steps = np.arange(0, batch.num_rows, rows or max(batch.num_rows, 1))
        cuts = np.unique(np.r_[steps, np.flatnonzero(np.diff(group)) + 1, batch.num_rows]).tolist()
        for start, end in zip(cuts[:-1], cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)


def give_back() -> None:
    """Free memory back to the system: a worker goes on to other tasks, and waits between."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, make: Callable, schema: str | T.StructType, *args) -> DataFrame:
    """``mapInArrow`` with a worker made from plain arguments inside the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from make(batches, *args)
        give_back()

    return df.mapInArrow(run, schema)


def uniform(*parts: Column | str | int) -> Column:
    """A number in [0, 1) that depends on its arguments, columns or constants, alone."""
    columns = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finalizer)."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges ``starts[i] .. starts[i] + lengths[i]``."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


# A key with more than this part of all rows is kept out of the shuffle of a join.
HOT_PART = 1000


def join_counted(left: DataFrame, right: DataFrame, key: str, times: str) -> DataFrame:
    """``left`` with the row of ``right`` for its ``key``, if any.

    ``right`` has one row per key and in ``times`` the number of rows of ``left`` with it, and
    is stored. At most ``HOT_PART`` keys can hold more than one in ``HOT_PART`` of those rows;
    these are broadcast, and their rows of ``left`` pass the shuffle under keys of their own.
    """
    total = right.agg(F.sum(times)).first()[0] or 0
    others = [c for c in right.columns if c not in (key, times)]
    held = right.select(
        F.col(key).alias("_key"), F.struct(*others).alias("_held"), F.col(times).alias("_times")
    )
    hot = held.where(F.col("_times") * HOT_PART > total).select("_key", "_held")
    cold = held.where(F.col("_times") * HOT_PART <= total)
    cold = cold.select(
        "_key", F.lit(-1).cast("long").alias("_spread"), F.col("_held").alias("_cold")
    )
    first = left.join(F.broadcast(hot), F.col(key) == F.col("_key"), "left").drop("_key")
    spread = F.when(F.col("_held").isNull(), -1).otherwise(F.monotonically_increasing_id())
    # Many keys are shuffled, not broadcast on the size of their compressed files.
    second = first.withColumn("_at", spread).join(
        cold.hint("merge"), (F.col(key) == F.col("_key")) & (F.col("_at") == F.col("_spread")), "left"
    )
    either = F.coalesce("_held", "_cold")
    return second.select(
        *[F.col(f"`{c}`") for c in left.columns], *[either[c].alias(c) for c in others]
    )
