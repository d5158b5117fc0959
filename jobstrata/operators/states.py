"""Stored aggregate states per partition, merged when the aggregate is read.

A state row holds what one partition of the landing table adds to one group and one cell of the
percentile histogram: exact sums, counts, and the lowest and highest value. States of different
partitions merge by adding up, so a load that replaces some partitions has only these read
again; the states of all others stand. What a merged histogram can't answer, the values inside
the few cells that hold a median, is read from the partitions that have such cells.

Each state carries the version of the partition it was made from: a hash of the partition's
files, by name, length and time of writing, which a listing gives without opening them. States
whose version is not the table's are never merged, so a load that failed half-way, a partition
that was dropped and files changed by others are noticed and made good by the next refresh.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata.contract import GROUP_COLUMNS
from jobstrata.operators.aggregates import impact_input, impact_parts, impact_table
from jobstrata.operators.percentiles import cell_counts, located_percentiles, merged_counts
from jobstrata.sources.writers import write_folder
from jobstrata.workspace import materialise

VERSION = "version"
# Partitions named one by one in a filter; beyond, the filter is a join.
NAMED_PARTITIONS = 1000
# What a folder of a null or empty partition value is called.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _part(name: str) -> str:
    return f"part_{name}"


def partition_versions(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """``part_`` columns with the partition values, as text, and the version of each partition
    below ``path``. Files are listed, not opened."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "modificationTime", "length")
    )
    values = []
    for key in keys:
        # Folder names are escaped like URLs, but for the plus sign.
        folder = F.regexp_extract("path", f"/{key}=([^/]*)/", 1)
        value = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
        values.append(F.when(folder != _NULL_FOLDER, value).alias(_part(key)))
    name = F.substring_index("path", "/", -1)
    hashed = F.xxhash64(name, "length", "modificationTime")
    return (
        files.select(*values, hashed.alias("_hash"))
        .groupBy(*[_part(key) for key in keys])
        .agg(F.xxhash64(F.bit_xor("_hash"), F.count(F.lit(1))).alias(VERSION))
    )


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(and_, [left[name].eqNullSafe(right[name]) for name in names])


def _in_partitions(table: DataFrame, keys: Sequence[str], partitions: DataFrame) -> DataFrame:
    """Rows of ``table`` in ``partitions``, whose files alone are read. The number of partitions
    is that of folders, which the driver lists to plan any scan."""
    wanted = partitions.select(*[_part(key) for key in keys]).distinct()
    rows = wanted.limit(NAMED_PARTITIONS + 1).collect()
    if not rows:
        return table.where(F.lit(False))
    if len(rows) > NAMED_PARTITIONS:
        named = wanted.select(*[F.col(_part(key)).alias(f"_{key}") for key in keys])
        same = [table[key].eqNullSafe(named[f"_{key}"]) for key in keys]
        return table.join(F.broadcast(named), reduce(and_, same), "left_semi")
    each = [
        reduce(and_, [F.col(key).eqNullSafe(F.lit(row[_part(key)])) for key in keys])
        for row in rows
    ]
    return table.where(reduce(or_, each))


def _states(table: DataFrame, keys: Sequence[str], versions: DataFrame) -> DataFrame:
    parts = [_part(key) for key in keys]
    marked = table.withColumns({_part(key): F.col(key) for key in keys})
    rows, value = impact_input(marked)
    counts = cell_counts(rows, [*parts, *GROUP_COLUMNS], value, impact_parts())
    named = versions.select(*[F.col(part).alias(f"_{part}") for part in parts], VERSION)
    same = reduce(and_, [F.col(part).eqNullSafe(F.col(f"_{part}")) for part in parts])
    return counts.join(F.broadcast(named), same).select(*counts.columns, VERSION)


def stored_states(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame | None:
    """The states below ``path``, or None before the first refresh."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException:
        return None
    # Partition values are texts, whatever they look like.
    texts = {_part(key) for key in keys}
    schema = [T.StructField(f.name, T.StringType()) if f.name in texts else f for f in found.schema]
    return spark.read.schema(T.StructType(schema)).parquet(path)


def refresh_states(
    table: DataFrame, table_path: str, states_path: str, keys: Sequence[str]
) -> list[tuple]:
    """Make the states of partitions whose files changed, and name these partitions.

    ``table`` is stored below ``table_path`` in folders by ``keys``, whose values are texts, and
    was read after its last load.
    """
    spark, parts = table.sparkSession, [_part(key) for key in keys]
    versions = materialise(partition_versions(spark, table_path, keys), "versions")
    before, stale = stored_states(spark, states_path, keys), versions
    rows = table
    if before is not None:
        valid = before.select(*parts, VERSION).distinct()
        stale = versions.join(valid, _same(versions, valid, [*parts, VERSION]), "left_anti")
        stale = materialise(stale, "stale")
        rows = _in_partitions(table, keys, stale)
    changed = [tuple(row[part] for part in parts) for row in stale.collect()]
    if changed:
        write_folder(_states(rows, keys, stale), states_path, "parquet", parts)
    return changed


def valid_states(
    spark: SparkSession, table_path: str, states_path: str, keys: Sequence[str]
) -> DataFrame:
    """States made from the files that the table has now; raises where some are missing."""
    parts = [_part(key) for key in keys]
    versions = materialise(partition_versions(spark, table_path, keys), "versions")
    states = stored_states(spark, states_path, keys)
    if states is None:
        raise ValueError(f"no states below {states_path}; refresh them first")
    same = _same(states, versions, [*parts, VERSION])
    valid = states.join(F.broadcast(versions), same, "left_semi")
    made = states.select(*parts, VERSION).distinct()
    missing = versions.join(made, _same(versions, made, [*parts, VERSION]), "left_anti").count()
    if missing:
        raise ValueError(f"{missing} partitions have no states of their files; refresh them first")
    return valid


def impact_from_states(
    table: DataFrame, table_path: str, states_path: str, keys: Sequence[str]
) -> DataFrame:
    """The functional table, merged from states; equal to ``impact_aggregate`` of ``table``."""
    valid = valid_states(table.sparkSession, table_path, states_path, keys)
    histogram = materialise(merged_counts(valid, GROUP_COLUMNS, impact_parts()), "merged")

    def rows_of(cells: DataFrame) -> DataFrame:
        at = [*GROUP_COLUMNS, "_cell"]
        named = cells.select(*at).distinct()
        holding = valid.join(named, _same(valid, named, at), "left_semi")
        return impact_input(_in_partitions(table, keys, holding))[0]

    value = impact_input(table)[1]
    located = located_percentiles(
        histogram, rows_of, GROUP_COLUMNS, value, {"median": 0.5}, list(impact_parts())
    )
    return impact_table(located)
