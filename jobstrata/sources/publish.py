"""Tables built beside the ones in use and published when they are complete.

A rebuild writes into a fresh folder under a name of its own. Only when it has ended does the
table change over: by one change of its location where columns and partitioning stay, otherwise
by two renames, the old table first. Until then readers have the old rows, and a rebuild that
fails leaves them as they are. ``recover`` puts back a table whose change was cut off between the
two renames.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

from jobstrata.sources import catalog
from jobstrata.workspace import remove

# What is appended to a table's name while it is built, and while it is replaced.
BUILT, REPLACED = "__next", "__old"


def location_of(spark: SparkSession, table: str) -> str:
    found = catalog.describe_value(spark, table, "Location")
    if found is None:
        raise ValueError(f"{table} has no location")
    return found


def _layout(spark: SparkSession, table: str) -> tuple:
    columns = spark.catalog.listColumns(table)
    names = [(c.name, c.dataType, c.isPartition) for c in columns]
    return names, catalog.storage_format(spark, table), catalog.describe_value(spark, table, "Type")


def recover(spark: SparkSession, table: str) -> None:
    """Undo what an interrupted rebuild has left: a table without its name gets it back, and
    a half-built one goes."""
    old, built = table + REPLACED, table + BUILT
    if spark.catalog.tableExists(old):
        if spark.catalog.tableExists(table):
            folder = location_of(spark, old)
            spark.sql(f"DROP TABLE {catalog.quoted(old)}")
            if folder != location_of(spark, table):
                remove(spark, folder)
        else:
            spark.sql(f"ALTER TABLE {catalog.quoted(old)} RENAME TO {catalog.quoted(table)}")
    if spark.catalog.tableExists(built):
        folder = location_of(spark, built)
        spark.sql(f"DROP TABLE {catalog.quoted(built)}")
        if not spark.catalog.tableExists(table) or folder != location_of(spark, table):
            remove(spark, folder)


def publish(spark: SparkSession, table: str) -> None:
    """Put the external table built as ``table`` + ``BUILT`` in the place of ``table``."""
    built, old = table + BUILT, table + REPLACED
    fresh = location_of(spark, built)
    if not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {catalog.quoted(built)} RENAME TO {catalog.quoted(table)}")
        return
    before = location_of(spark, table)
    layout = _layout(spark, table)
    partitioned = any(c[2] for c in layout[0])
    if layout == _layout(spark, built) and not partitioned:
        place = catalog.literal(fresh)
        spark.sql(f"ALTER TABLE {catalog.quoted(table)} SET LOCATION {place}")
        spark.sql(f"DROP TABLE {catalog.quoted(built)}")
    else:
        spark.sql(f"ALTER TABLE {catalog.quoted(table)} RENAME TO {catalog.quoted(old)}")
        spark.sql(f"ALTER TABLE {catalog.quoted(built)} RENAME TO {catalog.quoted(table)}")
        # A managed table moved its folder with its name.
        before = location_of(spark, old)
        spark.sql(f"DROP TABLE {catalog.quoted(old)}")
    spark.catalog.refreshTable(table)
    if before != location_of(spark, table):
        remove(spark, before)


def rebuild(
    spark: SparkSession, table: str, location: str, build: Callable[[str, str], int]
) -> int:
    """Build ``table`` anew and publish it; returns what ``build`` does, the rows written.

    ``build`` is given a table name and a fresh folder beside ``location``, and has to leave an
    external table of that name there. If it fails, the table stays as it is.
    """
    recover(spark, table)
    built = table + BUILT
    fresh = f"{location.rstrip('/')}-{uuid.uuid4().hex}"
    try:
        written = build(built, fresh)
    except BaseException:
        if spark.catalog.tableExists(built):
            spark.sql(f"DROP TABLE {catalog.quoted(built)}")
        remove(spark, fresh)
        raise
    publish(spark, table)
    return written


def drop_others(spark: SparkSession, database: str, kept: Iterable[str]) -> list[str]:
    """Drop the tables of a layer that its rebuild did not make, with external ones' folders."""
    names = {name.lower() for name in kept}
    gone = []
    for row in catalog.list_tables(spark, database).where("NOT isTemporary").collect():
        if row["tableName"].lower() in names:
            continue
        table = f"{database}.{row['tableName']}"
        folder = location_of(spark, table)
        spark.sql(f"DROP TABLE {catalog.quoted(table)}")
        remove(spark, folder)
        gone.append(row["tableName"])
    return gone
