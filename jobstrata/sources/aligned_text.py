"""Delimited text whose files have the contract's columns in orders of their own.

Each file's header is parsed like any record, so names may hold commas, quotes and newlines, and
says where that file keeps each column of the contract. Rows of all files are parsed by position,
joined to their file's header, and put in the order of the contract. Columns that a file lacks
are null there, and those that the contract does not have are left out; both are reported per
file. A row is malformed if it has another number of values than its own header.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata.contract import RAW
from jobstrata.operators.quality import MALFORMED_LINE
from jobstrata.sources.split_text import marked_lines, parsed, records
from jobstrata.workspace import materialise

# Headers are broadcast up to this size, which is measured; more are joined by shuffle.
BROADCAST_BYTES = 64 << 20


def _numbered(width: int) -> list[str]:
    return [f"c{at}" for at in range(width)]


def file_headers(
    spark: SparkSession,
    path: str,
    contract: T.StructType = RAW,
    *,
    quote_escape: str = "\\",
    marked: DataFrame | None = None,
) -> DataFrame:
    """file, its header's names in lower case, where each column of the contract is (null:
    nowhere), and the names that are missing, not in the contract, and given twice."""
    text = records(
        spark, path, header=False, quote_escape=quote_escape, first_only=True, marked=marked
    )
    text = materialise(text, "headers")
    # No header has more names than commas and one.
    commas = F.length("value") - F.length(F.replace("value", F.lit(","), F.lit("")))
    width = (text.agg(F.max(commas)).first()[0] or 0) + 1
    row = parsed("value", _numbered(width), quote_escape)
    # A missing name is null; an empty one in the middle stays a name.
    all_names = F.array(*[row[c] for c in _numbered(width)])
    last = F.array_max(
        F.transform(all_names, lambda name, at: F.when(name.isNotNull(), at + 1).otherwise(0))
    )
    names = F.transform(
        F.slice(all_names, F.lit(1), last), lambda n: F.lower(F.trim(F.coalesce(n, F.lit(""))))
    )
    wanted = F.array(*[F.lit(name.lower()) for name in contract.names])
    found = text.select("file", names.alias("names"))
    place = F.transform(wanted, lambda n: F.nullif(F.array_position("names", n), F.lit(0)) - 1)
    twice = F.filter(
        F.array_distinct("names"),
        lambda n: F.size(F.filter("names", lambda other: other == n)) > 1,
    )
    return found.select(
        "file",
        "names",
        place.alias("places"),
        F.array_except(wanted, "names").alias("missing"),
        F.array_except("names", wanted).alias("unknown"),
        twice.alias("twice"),
    )


def aligned_scan(
    spark: SparkSession, path: str, contract: T.StructType = RAW, *, quote_escape: str = "\\"
) -> DataFrame:
    """All rows in the order of the contract, with ``malformed_line`` as in
    ``quality.scan_with_arity``. A header that gives a name of the contract twice is refused."""
    # Lines are put in order once, for headers and rows.
    marked = marked_lines(spark, path, quote_escape=quote_escape)
    headers = file_headers(spark, path, contract, quote_escape=quote_escape, marked=marked)
    headers = materialise(headers)
    wanted = F.array(*[F.lit(name.lower()) for name in contract.names])
    twice = headers.where(F.arrays_overlap("twice", wanted)).select("file", "twice").first()
    if twice is not None:
        raise ValueError(f"{twice['file']}: {', '.join(twice['twice'])} given twice")
    sizes = headers.agg(
        F.sum(F.octet_length("file") + 16 * F.size("places")).alias("bytes"),
        F.collect_set(F.size("names")).alias("widths"),
    ).first()
    places = headers.select(
        F.col("file").alias("_file"), "places", F.size("names").alias("width")
    )
    if (sizes["bytes"] or 0) <= BROADCAST_BYTES:
        places = F.broadcast(places)
    rows = records(spark, path, quote_escape=quote_escape, marked=marked).where("value <> ''")
    joined = rows.join(places, F.col("file") == F.col("_file"))
    # Headers differ in few widths; each is a parse of its own, so that arity is told by it.
    # A parse is a column, so that it is done once a row and not once a value.
    widths = sizes["widths"] or [1]
    for width in widths:
        row = parsed("value", _numbered(width), quote_escape)
        joined = joined.withColumn(f"_row{width}", F.when(F.col("width") == width, row))
    values, malformed = F.lit(None), F.lit(None)
    for width in widths:
        here, row = F.col("width") == width, F.col(f"_row{width}")
        values = F.when(here, F.array(*[row[c] for c in _numbered(width)])).otherwise(values)
        malformed = F.when(here, row[MALFORMED_LINE]).otherwise(malformed)
    placed = joined.select(values.alias("values"), malformed.alias(MALFORMED_LINE), "places")
    return placed.select(
        *[
            F.get("values", F.get("places", F.lit(at))).alias(name)
            for at, name in enumerate(contract.names)
        ],
        MALFORMED_LINE,
    )
