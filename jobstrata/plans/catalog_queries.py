"""Registered queries over databases and tables of the session's own catalog.

Each works in a database of its own below the work folder and drops it once its result is
stored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.contract import (
    MEASURE_COLUMNS,
    RAW,
    RAW_COLUMNS,
    avro_contract,
    load_avro_contract,
    string_schema,
)
from jobstrata.functions import to_double
from jobstrata.operators import projections, quality
from jobstrata.plans.standin import postings
from jobstrata.sources import catalog, publish, writers
from jobstrata.workspace import materialise, new_path

_ROWS = "SELECT * FROM postings WHERE {}"
_NUMBERED = {name: f"column_{at}" for at, name in enumerate(RAW_COLUMNS, start=1)}
_AGAIN = "city = 'city_3' AND industry = 'building'"
_FILLED = "\nUNION ALL ".join(
    f"SELECT '{name}' AS column_name, count({name}) AS filled FROM postings"
    for name in RAW_COLUMNS
)


@contextmanager
def _database(spark: SparkSession) -> Iterator[str]:
    name = f"jobs_{uuid.uuid4().hex}"
    catalog.ensure_database(spark, name, new_path(spark, name))
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def _by_city(spark: SparkSession, sf_dir: str, database: str) -> tuple[str, DataFrame]:
    """A table of whole postings partitioned by city, with its rows inserted."""
    rows = postings(spark, sf_dir)
    table = f"{database}.by_city"
    path = new_path(spark, "by-city")
    catalog.create_source_table(spark, table, path, RAW, "parquet", partitioned_by=["city"])
    catalog.insert_overwrite(rows, table, ["city"], few_values=True)
    return table, rows


def _overwritten(spark: SparkSession, sf_dir: str, dynamic: bool) -> DataFrame:
    with _database(spark) as database:
        table, rows = _by_city(spark, sf_dir, database)
        catalog.insert_overwrite(rows.where(_AGAIN), table, ["city"], dynamic=dynamic)
        return materialise(spark.table(table))


def catalog_overwrite(spark, sf_dir):
    """A partitioned table, of which one partition is written again with one industry."""
    return _overwritten(spark, sf_dir, dynamic=True)


def static_overwrite(spark, sf_dir):
    """The same, but the second write replaces the whole table."""
    return _overwritten(spark, sf_dir, dynamic=False)


def managed_table(spark, sf_dir):
    """The curated table as a managed Parquet table, written twice."""
    rows = materialise(postings(spark, sf_dir))
    with _database(spark) as database:
        table = f"{database}.curated"
        for _ in range(2):
            writers.save_parquet_table(projections.curated_postings(rows), table)
        return materialise(spark.table(table))


def raw_text_table(spark, sf_dir):
    """All postings through an external text table of the raw layer."""
    with _database(spark) as database:
        table = f"{database}.texts"
        catalog.create_text_table(spark, table, new_path(spark, "texts"), RAW)
        catalog.insert_overwrite(postings(spark, sf_dir), table)
        back = spark.table(table)
        return materialise(
            back.withColumns({name: to_double(F.col(name)) for name in MEASURE_COLUMNS})
        )


def positional_insert(spark, sf_dir):
    """Columns of other names inserted by position."""
    with _database(spark) as database:
        table = f"{database}.positions"
        schema = string_schema(_NUMBERED.values())
        catalog.create_source_table(spark, table, new_path(spark, "positions"), schema, "parquet")
        catalog.insert_overwrite(postings(spark, sf_dir), table)
        return materialise(spark.table(table))


def view_handover(spark, sf_dir):
    """Postings handed on as a view and queried by its name."""
    view = f"handed_{uuid.uuid4().hex}"
    catalog.register_view(postings(spark, sf_dir), view)
    result = materialise(spark.sql(f"SELECT industry, count(*) AS jobs FROM {view} GROUP BY 1"))
    spark.catalog.dropTempView(view)
    return result


def layer_reset(spark, sf_dir):
    """A database with a table per run, then reset: rows and tables before, tables after."""
    name = f"jobs_{uuid.uuid4().hex}"
    path = new_path(spark, name)
    catalog.ensure_database(spark, name, path)
    rows = postings(spark, sf_dir).select("job_id")
    writers.save_parquet_table(rows, f"{name}.ids")

    def tables():
        return catalog.list_tables(spark, name).where("NOT isTemporary").count()

    counted = spark.table(f"{name}.ids").agg(
        F.count("*").alias("rows_before"), F.lit(tables()).cast("long").alias("tables_before")
    )
    counted = materialise(counted)
    catalog.ensure_database(spark, name, path, reset=True)
    after = tables()
    spark.sql(f"DROP DATABASE {name} CASCADE")
    return counted.withColumn("tables_after", F.lit(after).cast("long"))


def reset_after_failure(spark, sf_dir):
    """A table of all postings, read after a rebuild of it has failed half-way."""
    with _database(spark) as database:
        table, path = f"{database}.postings", new_path(spark, "postings")
        rows = materialise(postings(spark, sf_dir))

        def build(df):
            return lambda name, folder: writers.save_parquet_table(df, name, folder)

        publish.rebuild(spark, table, path, build(rows))
        fails = F.when(F.col("city") == "city_3", F.raise_error(F.lit("a bad row")))
        try:
            spoiled = rows.withColumn("city", F.coalesce(fails.cast("string"), "city"))
            publish.rebuild(spark, table, path, build(spoiled))
        except PySparkException:
            return materialise(spark.table(table))
    raise AssertionError("the rebuild was to fail")


def table_listing(spark, sf_dir):
    """A table per company size, listed by name."""
    with _database(spark) as database:
        sizes = postings(spark, sf_dir).select(F.lower("company_size").alias("size"), "job_id")
        sizes = materialise(sizes)
        for row in sizes.select("size").distinct().collect():
            one = sizes.where(F.col("size") == row["size"])
            writers.save_parquet_table(one, f"{database}.jobs_{row['size']}")
        listed = catalog.list_tables(spark, database).where("NOT isTemporary")
        return materialise(listed.select(F.col("tableName").alias("table_name")))


def partition_listing(spark, sf_dir):
    """The partitions of a table by city."""
    with _database(spark) as database:
        table, _ = _by_city(spark, sf_dir, database)
        return materialise(catalog.list_partitions(spark, table))


def described_storage(spark, sf_dir):
    """Format and codec of a stored table, from its description, with its rows."""
    with _database(spark) as database:
        table, _ = _by_city(spark, sf_dir, database)
        catalog.require_storage(spark, table, "parquet", "snappy")
        return materialise(
            spark.table(table).agg(
                F.lit(catalog.storage_format(spark, table)).alias("storage"),
                F.lit(catalog.storage_codec(spark, table)).alias("codec"),
                F.count("*").alias("row_count"),
            )
        )


def contract_loaded(spark, sf_dir):
    """The columns of a stored Avro contract, each with its filled postings."""
    path = new_path(spark, "contract")
    text = avro_contract(RAW, "job_postings")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    names = load_avro_contract(spark, path, string_schema(["fallback"])).names
    counted = postings(spark, sf_dir).agg(*[F.count(name).alias(name) for name in names])
    rows = [F.struct(F.lit(n).alias("column_name"), F.col(n).alias("filled")) for n in names]
    return counted.select(F.inline(F.array(*rows)))


def empty_refused(spark, sf_dir):
    """Which sizes of company, and one that does not exist, have no postings to export."""
    sizes = materialise(postings(spark, sf_dir).select("company_size", "job_id"))
    wanted = [r["company_size"] for r in sizes.select("company_size").distinct().collect()]
    outcome = []
    for size in [*wanted, "None"]:
        try:
            quality.refuse_empty(sizes.where(F.col("company_size") == size))
            outcome.append((size, False))
        except ValueError:
            outcome.append((size, True))
    return spark.createDataFrame(outcome, "company_size string, refused boolean")


def header_check(spark, sf_dir):
    """A text file per industry, each a folder of parts, one of them with two columns exchanged:
    files seen and files refused, which one part is enough for."""
    path = new_path(spark, "headers")
    rows = materialise(postings(spark, sf_dir))
    order = list(RAW_COLUMNS)
    exchanged = [{"country": "region", "region": "country"}.get(name, name) for name in order]
    kinds = [r["industry"] for r in rows.select("industry").distinct().orderBy("industry").collect()]
    for at, kind in enumerate(kinds):
        part = rows.where(F.col("industry").eqNullSafe(kind))
        text = part.select(*(exchanged if kind == "building" else order))
        writer = text.write.options(header=True, quoteAll=True, compression="snappy")
        writer.csv(f"{path}/{at}.csv")
    parts = quality.header_check(spark, path)
    folder = F.regexp_extract("file", "/([^/]+)/[^/]+$", 1)
    files = parts.groupBy(folder.alias("file")).agg(F.min("agrees").alias("agrees"))
    return files.agg(
        F.count("*").alias("files"), F.count(F.when(~F.col("agrees"), 1)).alias("refused")
    )


def add(register, curated_sql: str, text_sql: str) -> None:
    """Register every query above with its SQL."""
    kept = "city <> 'city_3' OR industry = 'building'"
    for query, sql in (
        (catalog_overwrite, _ROWS.format(kept)),
        (static_overwrite, _ROWS.format(_AGAIN)),
        (managed_table, curated_sql),
        (raw_text_table, text_sql),
        (
            positional_insert,
            "SELECT {} FROM postings".format(
                ", ".join(f"{name} AS {other}" for name, other in _NUMBERED.items())
            ),
        ),
        (view_handover, "SELECT industry, count(*) AS jobs FROM postings GROUP BY 1"),
        (
            layer_reset,
            "SELECT count(*) AS rows_before, CAST(1 AS BIGINT) AS tables_before, "
            "CAST(0 AS BIGINT) AS tables_after FROM postings",
        ),
        (reset_after_failure, "SELECT * FROM postings"),
        (
            table_listing,
            "SELECT DISTINCT 'jobs_' || lower(company_size) AS table_name FROM postings",
        ),
        (partition_listing, "SELECT DISTINCT 'city=' || city AS partition FROM postings"),
        (
            described_storage,
            "SELECT 'parquet' AS storage, 'snappy' AS codec, count(*) AS row_count FROM postings",
        ),
        (contract_loaded, _FILLED),
        (
            empty_refused,
            "SELECT DISTINCT company_size, false AS refused FROM postings "
            "UNION ALL SELECT 'None', true",
        ),
        (
            header_check,
            "SELECT count(DISTINCT industry) AS files, "
            "count(DISTINCT CASE WHEN industry = 'building' THEN 1 END) AS refused FROM postings",
        ),
    ):
        register(query.__name__, sql)(query)
