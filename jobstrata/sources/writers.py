"""Sinks: lossless text, partitioned folders, Parquet tables, CSV exports, documents.

Every sink overwrites and returns the number of rows it wrote. The count is taken by the
write's own last stage, so it needs no further pass and repeated upstream tasks do not add
to it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F

from jobstrata.sources import documents
from jobstrata.sources.readers import LOSSLESS_CSV, PLAIN_CSV

# Bounds a text file, which is read by one task because quoted newlines are allowed.
ROWS_PER_TEXT_FILE = 1_000_000
# Of the raw layer's text, whose files are read whole anyway.
TEXT_CODEC = "snappy"


def counted_write(df: DataFrame, write: Callable[[DataFrameWriter], None]) -> int:
    """Run ``write`` on the writer of ``df`` and return the rows that passed through."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")).write)
    return seen.get["rows"]


def _write_text(
    df: DataFrame,
    path: str,
    options: Mapping[str, str],
    rows_per_file: int = ROWS_PER_TEXT_FILE,
) -> int:
    return counted_write(
        df,
        lambda writer: writer.mode("overwrite")
        .options(**options)
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path),
    )


def write_lossless_csv(df: DataFrame, path: str) -> int:
    """Quoted text that reads back exactly, in compressed files of bounded size."""
    return _write_text(df, path, {**LOSSLESS_CSV, "compression": TEXT_CODEC})


def write_folder(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partitioned_by: Sequence[str] = (),
    *,
    dynamic: bool = True,
    few_values: bool = False,
) -> int:
    """A table folder with Snappy output.

    With partition columns and ``dynamic`` only partitions present in ``df`` are replaced,
    otherwise the whole folder is. Rows are rebalanced by partition value, which AQE splits
    where one value is large; with ``few_values`` they are not shuffled, and each task writes a
    file per value that it holds.
    """
    if partitioned_by and not few_values:
        df = df.hint("rebalance", *partitioned_by)

    def write(writer: DataFrameWriter) -> None:
        writer = writer.mode("overwrite").format(fmt).option("compression", "snappy")
        if partitioned_by:
            mode = "dynamic" if dynamic else "static"
            writer = writer.option("partitionOverwriteMode", mode).partitionBy(*partitioned_by)
        writer.save(path)

    return counted_write(df, write)


def save_parquet_table(df: DataFrame, table: str, path: str | None = None) -> int:
    """A managed Parquet table, or an external one at ``path``."""
    options = {"path": path} if path else {}
    return counted_write(
        df,
        lambda writer: writer.mode("overwrite")
        .format("parquet")
        .options(**options)
        .saveAsTable(table),
    )


def export_csv(
    df: DataFrame,
    path: str,
    *,
    plain: bool = False,
    single_file: bool = False,
    compression: str = "none",
) -> int:
    """A CSV export with header, in parallel files.

    ``plain`` writes what a consumer without our options expects: quotes only where needed
    and nothing for null, which an empty text cannot be told from. ``single_file``
    writes exactly one file, whatever the size, and so through one task. ``compression`` names
    a codec that the consumer reads.
    """
    options = {**(PLAIN_CSV if plain else LOSSLESS_CSV), "compression": compression}
    if single_file:
        return _write_text(df.repartition(1), path, options, rows_per_file=0)
    return _write_text(df, path, options)


def write_documents(
    df: DataFrame,
    fmt: str = "json",
    *,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> int:
    """A document collection; ``fmt`` names the connector, JSON lines by default, or
    ``documents.NAME``."""
    if fmt == documents.NAME:
        documents.register(df.sparkSession)

    def write(writer: DataFrameWriter) -> None:
        writer = writer.format(fmt).mode("overwrite").options(**(options or {}))
        writer.save(path) if path else writer.save()

    return counted_write(df, write)
