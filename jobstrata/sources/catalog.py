"""Catalog work: databases, table definitions, positional overwrites, introspection."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata.contract import avro_contract
from jobstrata.operators.projections import lowercase_columns, partition_last
from jobstrata.sources.readers import LOSSLESS_CSV
from jobstrata.sources.writers import ROWS_PER_TEXT_FILE, TEXT_CODEC, counted_write


def quoted(identifier: str) -> str:
    """An identifier as SQL takes it."""
    return ".".join(f"`{part}`" for part in identifier.split("."))


def literal(value: str) -> str:
    """A text as SQL takes it."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _pairs(properties: dict[str, str]) -> str:
    return ", ".join(f"{literal(key)} = {literal(value)}" for key, value in properties.items())


# What Hive takes from the session when it writes: output codec and dynamic partitions.
HIVE_AVRO_SETTINGS = {
    "hive.exec.compress.output": "true",
    "avro.output.codec": "snappy",
    "hive.exec.dynamic.partition": "true",
    "hive.exec.dynamic.partition.mode": "nonstrict",
}


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the duration of one write; ``insertInto`` takes no options."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def ensure_database(spark: SparkSession, database: str, location: str, *, reset=False) -> None:
    """Create a layer's database at ``location``; ``reset`` first drops it with its tables."""
    if reset:
        spark.sql(f"DROP DATABASE IF EXISTS {quoted(database)} CASCADE")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)} LOCATION {literal(location)}")


def register_view(df: DataFrame, view: str) -> None:
    df.createOrReplaceTempView(view)


def create_text_table(
    spark: SparkSession, table: str, location: str, schema: T.StructType
) -> None:
    """External all-string ``,`` text table with Snappy output. Values are quoted, so commas, quotes, newlines,
    blanks, empty strings and nulls read back as written."""
    columns = ", ".join(f"{quoted(field.name)} STRING" for field in schema.fields)
    limits = {"multiLine": "true", "maxRecordsPerFile": str(ROWS_PER_TEXT_FILE)}
    options = _pairs({**LOSSLESS_CSV, **limits, "compression": TEXT_CODEC})
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({columns}) "
        f"USING csv OPTIONS ({options}) LOCATION {literal(location)}"
    )


def _columns_sql(schema: T.StructType, partitioned_by: Sequence[str]) -> tuple[list[str], str]:
    types = {field.name.lower(): field.dataType.simpleString() for field in schema.fields}
    body = [f"{quoted(name)} {kind}" for name, kind in types.items() if name not in partitioned_by]
    keys = ", ".join(f"{quoted(name)} {types[name]}" for name in partitioned_by)
    return body, f" PARTITIONED BY ({keys})" if partitioned_by else ""


def hive_avro_ddl(
    table: str,
    location: str,
    schema: T.StructType,
    *,
    schema_url: str | None = None,
    partitioned_by: Sequence[str] = (),
) -> str:
    """DDL of a Snappy Avro table on the Hive SerDe.

    The Avro contract is read from ``schema_url``, or written into the table when no URL is
    given. It holds the columns that are not partition columns.
    """
    body, partition_clause = _columns_sql(schema, partitioned_by)
    data_fields = [f for f in schema.fields if f.name.lower() not in partitioned_by]
    properties = {"avro.output.codec": "snappy"}
    if schema_url:
        properties["avro.schema.url"] = schema_url
    else:
        record = table.split(".")[-1]
        properties["avro.schema.literal"] = avro_contract(T.StructType(data_fields), record)
    return (
        f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({', '.join(body)}){partition_clause} "
        f"STORED AS AVRO LOCATION {literal(location)} TBLPROPERTIES ({_pairs(properties)})"
    )


def create_hive_avro_table(
    spark: SparkSession,
    table: str,
    location: str,
    schema: T.StructType,
    *,
    schema_url: str | None = None,
    partitioned_by: Sequence[str] = (),
) -> None:
    """Create the table of :func:`hive_avro_ddl`; needs a session with Hive support."""
    layout = {"schema_url": schema_url, "partitioned_by": partitioned_by}
    spark.sql(hive_avro_ddl(table, location, schema, **layout))


def create_source_table(
    spark: SparkSession,
    table: str,
    location: str,
    schema: T.StructType,
    fmt: str,
    *,
    partitioned_by: Sequence[str] = (),
) -> None:
    """External Snappy table on a Spark data source, such as ``avro`` or ``parquet``."""
    types = [f"{quoted(f.name.lower())} {f.dataType.simpleString()}" for f in schema.fields]
    keys = ", ".join(quoted(name) for name in partitioned_by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({', '.join(types)}) USING {fmt} "
        f"OPTIONS ('compression' = 'snappy') "
        + (f"PARTITIONED BY ({keys}) " if keys else "")
        + f"LOCATION {literal(location)}"
    )


def insert_overwrite(
    df: DataFrame,
    table: str,
    partitioned_by: Sequence[str] = (),
    *,
    dynamic: bool = True,
    few_values: bool = False,
    settings: Mapping[str, str] | None = None,
) -> int:
    """Overwrite a table by position and return the rows written; a different number of
    columns is an error.

    With partition columns and ``dynamic`` only the partitions present in ``df`` are
    replaced, otherwise the whole table is. Rows are rebalanced by partition value, which
    AQE splits where one value is large; with ``few_values`` they are not shuffled, and each
    task writes a file per value that it holds. ``settings`` hold for the write alone; a Hive table
    needs ``HIVE_AVRO_SETTINGS``, and replaces only partitions present in ``df`` either way.
    """
    df = lowercase_columns(df)
    keys = [name.lower() for name in partitioned_by]
    if keys:
        df = partition_last(df, *keys)
        df = df if few_values else df.hint("rebalance", *keys)
    mode = "dynamic" if keys and dynamic else "static"
    values = {"spark.sql.sources.partitionOverwriteMode": mode, **(settings or {})}
    with _settings(df.sparkSession, values):
        return counted_write(df, lambda writer: writer.insertInto(table, overwrite=True))


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {quoted(database)}")


def list_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {quoted(table)}")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE FORMATTED {quoted(table)}")


def describe_value(spark: SparkSession, table: str, entry: str) -> str | None:
    """One entry of the table description, such as ``InputFormat`` or ``Provider``."""
    row = (
        describe_table(spark, table).filter(F.col("col_name") == entry).select("data_type").first()
    )
    return row[0] if row else None


def storage_format(spark: SparkSession, table: str) -> str | None:
    """Hive input format of a SerDe table, else the data source of the table."""
    return describe_value(spark, table, "InputFormat") or describe_value(spark, table, "Provider")


def storage_codec(spark: SparkSession, table: str) -> str | None:
    """Compression codec named in a table's properties or storage options."""
    properties = describe_table(spark, table).where(
        F.col("col_name").isin("Table Properties", "Storage Properties")
    )
    codec = F.regexp_extract("data_type", r"(?:avro\.output\.codec|compression)=(\w+)", 1)
    row = properties.select(codec.alias("codec")).where("codec <> ''").first()
    return row[0].lower() if row else None


def require_storage(spark: SparkSession, table: str, fmt: str, codec: str = "snappy") -> str:
    """Storage format of a table, or raise when it is not ``fmt`` with ``codec``."""
    stored, packed = storage_format(spark, table) or "unknown", storage_codec(spark, table)
    if fmt not in stored.lower() or packed != codec:
        raise ValueError(f"{table} is stored as {stored} with {packed}, not {fmt} with {codec}")
    return stored


def require_avro(spark: SparkSession, table: str) -> str:
    """Storage format of a landing table, or raise when it is not Avro with Snappy."""
    return require_storage(spark, table, "avro")
