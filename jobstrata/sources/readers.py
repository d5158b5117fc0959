"""Scans: delimited text, catalog tables, exported CSV, documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from jobstrata.contract import RAW
from jobstrata.operators.inference import inferred_schema
from jobstrata.sources import documents

# Both ways of the lossless text form. Every value is quoted; null is the bare sentinel
# text, so a value equal to it would read back as null.
NULL_TEXT = "\\N"
LOSSLESS_CSV = {
    "header": "true",
    "sep": ",",
    "quoteAll": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": NULL_TEXT,
    "emptyValue": "",
    "encoding": "UTF-8",
}


PLAIN_CSV = {
    "header": "true",
    "sep": ",",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}

def read_raw_csv(
    spark: SparkSession, path: str, schema: T.StructType = RAW, *, multi_line: bool = False
) -> DataFrame:
    """Header-bearing ``,`` text as strings, by position and without inference.

    Short rows are padded with null, long rows lose the tail (see ``quality.row_arity``).
    ``multi_line`` accepts newlines inside quoted values; such a file is read by one task.
    """
    return (
        spark.read.options(header=True, sep=",", inferSchema=False, multiLine=multi_line)
        .schema(schema)
        .csv(path)
    )


def read_lossless_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read what ``writers.write_lossless_csv`` wrote, one task per file."""
    return spark.read.options(**LOSSLESS_CSV, multiLine="true").schema(schema).csv(path)


def read_csv_export(
    spark: SparkSession, pattern: str, schema: T.StructType | None, *, plain: bool = False
) -> DataFrame:
    """Exported CSV by path or glob. Without a schema the types are inferred from all values of
    all files, at the cost of a second pass over the text."""
    options = {**(PLAIN_CSV if plain else LOSSLESS_CSV), "multiLine": "true"}
    if schema is None:
        schema = inferred_schema(spark.read.options(**options).csv(pattern))
    return spark.read.options(**options).schema(schema).csv(pattern)


def read_documents(
    spark: SparkSession,
    fmt: str = "json",
    *,
    path: str | None = None,
    schema: T.StructType | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a document collection; ``fmt`` names the connector, JSON lines by default, or
    ``documents.NAME``, the collection of files that comes with the library."""
    if fmt == documents.NAME:
        documents.register(spark)
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()
