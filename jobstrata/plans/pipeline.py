"""The layered pipeline: raw text -> landing -> functional and curated -> exports.

Each layer is one function over the stored result of the layer before; rows are counted by
the write itself.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata import config as names
from jobstrata.config import HIVE_AVRO, LakeConfig, TableConfig
from jobstrata.contract import FUNCTIONAL, load_avro_contract, string_schema
from jobstrata.operators import states
from jobstrata.operators.aggregates import impact_aggregate
from jobstrata.operators.fingerprint import Fingerprint, fingerprint_of, watched
from jobstrata.operators.projections import (
    align_by_position,
    curated_postings,
    partition_last,
)
from jobstrata.operators.quality import (
    MALFORMED_LINE,
    header_problems,
    refuse_empty,
    row_arity,
    scan_with_arity,
    structure_problems,
)
from jobstrata.plans.journal import Journal, as_report, folder_version, inputs_hash
from jobstrata.sources import catalog, documents, publish, readers, writers
from jobstrata.sources.aligned_text import aligned_scan, file_headers
from jobstrata.sources.split_text import scan_in_splits
from jobstrata.workspace import scratch


@dataclass(frozen=True)
class StepReport:
    """What a step wrote, and what a later read of its sink found."""

    layer: str
    table: str
    rows_written: int
    rows_read_back: int | None = None
    malformed_rows: int = 0
    content: Fingerprint | None = None
    content_read_back: Fingerprint | None = None

    @property
    def matches(self) -> bool:
        """Whether the sink was read back and holds what was written."""
        return self.rows_read_back == self.rows_written and self.content_read_back == self.content


def _problem(report: StepReport) -> str:
    where = f"{report.layer} {report.table}: {report.rows_written} rows written, "
    if report.rows_read_back is None:
        return where + "not read back"
    if report.rows_read_back != report.rows_written:
        return where + f"{report.rows_read_back} found"
    return where + "as many found, but with other values"


def _refuse(problem: str, cfg: LakeConfig) -> None:
    if cfg.on_mismatch == "warn":
        warnings.warn(problem)
    else:
        raise ValueError(problem)


def refuse_mismatch(report: StepReport, cfg: LakeConfig) -> None:
    """Raise where a step's sink holds other than what was written to it, or, with
    ``on_mismatch="warn"``, warn."""
    if not report.matches:
        _refuse(_problem(report), cfg)


def refuse_difference(before: StepReport, after: StepReport, cfg: LakeConfig) -> None:
    """The same for a step that copies the rows of the one before."""
    if (before.rows_written, before.content) != (after.rows_written, after.content):
        _refuse(
            f"{after.layer} {after.table}: {after.rows_written} rows copied, which are not the "
            f"{before.rows_written} of {before.layer} {before.table}",
            cfg,
        )


def _watched(df: DataFrame, cfg: LakeConfig) -> tuple[DataFrame, Callable[[], Fingerprint | None]]:
    """Rows to be written, and their fingerprint where contents are compared."""
    return watched(df) if cfg.verify == "content" else (df, lambda: None)


def _read_back(report: StepReport, stored: DataFrame) -> StepReport:
    """The report with what ``stored``, the sink as it is read, holds."""
    if report.content is None:
        return replace(report, rows_read_back=stored.count())
    found = fingerprint_of(stored)
    return replace(report, rows_read_back=found.rows, content_read_back=found)


def _prepare(spark: SparkSession, cfg: LakeConfig, layer: str) -> None:
    if cfg.use_catalog:
        catalog.ensure_database(spark, cfg.database(layer), cfg.layer_path(layer))


def _built(
    spark: SparkSession, cfg: LakeConfig, layer: str, name: str, build: Callable[[str, str], int]
) -> int:
    """Write a layer's table by ``build``, which is given its name and folder: in place, or, with
    ``reset``, beside the old one, which it replaces at the end."""
    target, folder = cfg.table(layer, name), cfg.table_path(layer, name)
    if cfg.reset:
        return publish.rebuild(spark, target, folder, build)
    return build(target, folder)


def _landing_contract(table: TableConfig) -> T.StructType:
    return string_schema(name.lower() for name in table.schema.names)


def _stored_name(cfg: LakeConfig, layer: str, table: TableConfig) -> str:
    return cfg.aggregate(table) if layer == names.FUNCTIONAL else table.name


def load(spark: SparkSession, cfg: LakeConfig, layer: str, table: TableConfig) -> DataFrame:
    """The stored table of a layer."""
    name = _stored_name(cfg, layer, table)
    if cfg.use_catalog:
        return spark.table(cfg.table(layer, name))
    path = cfg.table_path(layer, name)
    if layer == names.WORKLOAD:
        return readers.read_lossless_csv(spark, path, table.schema)
    if layer == names.LANDING:
        # The contract keeps partition values from being read back as numbers.
        contract = _landing_contract(table)
        return spark.read.format(cfg.landing_format).schema(contract).load(path)
    return spark.read.parquet(path)


def _scanned(spark: SparkSession, cfg: LakeConfig, table: TableConfig) -> DataFrame:
    """Source rows, after a look at the headers of all files."""
    source, escape = cfg.source(table), table.quote_escape
    if cfg.align_headers:
        return aligned_scan(spark, source, table.schema, quote_escape=escape)
    if cfg.multi_line_source:
        headers = file_headers(spark, source, table.schema, quote_escape=escape)
        for row in headers.collect():
            problems = structure_problems(row["names"], table.schema)
            if problems:
                raise ValueError(f"header of {row['file']}: " + "; ".join(problems))
        return scan_in_splits(spark, source, table.schema, quote_escape=escape)
    problems = header_problems(spark, source, table.schema)
    if problems:
        raise ValueError(f"{source}: " + "; ".join(problems))
    return scan_with_arity(spark, source, table.schema, quote_escape=escape)


def ingest_raw(spark: SparkSession, cfg: LakeConfig, table: TableConfig) -> StepReport:
    """Source text into the raw layer, every value as it stands.

    A header that differs from the contract, in any file, is refused. Rows with too few or too
    many values are padded or cut, as in ``readers.read_raw_csv``, and counted in the report;
    their lines can be kept, and their number limited, by the settings.
    """
    source = cfg.source(table)
    scanned = _scanned(spark, cfg, table)
    limit = cfg.most_malformed_rows
    if limit is not None:
        malformed = row_arity(scanned).first()["malformed_rows"]
        if malformed > limit:
            raise ValueError(f"{source}: {malformed} malformed rows, at most {limit} allowed")
    if cfg.keep_rejects:
        # The first column is read along, as the parser needs one to tell malformed lines.
        rejects = scanned.where(F.col(MALFORMED_LINE).isNotNull()).select(
            MALFORMED_LINE, scanned.columns[0]
        )
        path = cfg.table_path(names.WORKLOAD, f"{table.name}_rejects")
        writers.write_lossless_csv(rejects, path)
    _prepare(spark, cfg, names.WORKLOAD)
    seen = Observation()
    rows = (
        scanned.observe(seen, F.count(MALFORMED_LINE).alias("malformed"))
        .drop(MALFORMED_LINE)
    )
    rows, content = _watched(rows, cfg)
    path = cfg.table_path(names.WORKLOAD, table.name)
    if cfg.use_catalog:

        def build(target: str, folder: str) -> int:
            catalog.create_text_table(spark, target, folder, table.schema)
            return catalog.insert_overwrite(rows, target)

        written = _built(spark, cfg, names.WORKLOAD, table.name, build)
    else:
        written = writers.write_lossless_csv(rows, path)
    report = StepReport(
        names.WORKLOAD,
        table.name,
        written,
        malformed_rows=seen.get["malformed"],
        content=content(),
    )
    return _read_back(report, load(spark, cfg, names.WORKLOAD, table))


def build_landing(spark: SparkSession, cfg: LakeConfig, table: TableConfig) -> StepReport:
    """Raw layer into the landing table of the contract, whole or partition by partition."""
    _prepare(spark, cfg, names.LANDING)
    source = load(spark, cfg, names.WORKLOAD, table)
    rows, content = _watched(source, cfg)
    keys = tuple(name.lower() for name in table.partitioned_by)
    dynamic = table.dynamic_partitions
    path = cfg.table_path(names.LANDING, table.name)
    if not cfg.use_catalog:
        rows = partition_last(align_by_position(rows, _landing_contract(table)), *keys)
        written = writers.write_folder(rows, path, cfg.landing_format, keys, dynamic=dynamic)
        report = StepReport(names.LANDING, table.name, written, content=content())
        return _read_back(report, _landed(spark, cfg, table, source))
    schema = table.schema
    if table.contract_path:
        schema = load_avro_contract(spark, table.contract_path, table.schema)
    hive = cfg.landing_format == HIVE_AVRO
    if hive and keys and not dynamic:
        # Hive replaces the partitions that it writes, whatever the setting.
        raise ValueError("a partitioned Hive table can't be overwritten as a whole")

    def build(target: str, folder: str) -> int:
        layout = {"partitioned_by": keys}
        if hive:
            layout["schema_url"] = table.contract_path
            catalog.create_hive_avro_table(spark, target, folder, schema, **layout)
        else:
            catalog.create_source_table(
                spark, target, folder, schema, cfg.landing_format, **layout
            )
        settings = catalog.HIVE_AVRO_SETTINGS if hive else {}
        n = catalog.insert_overwrite(rows, target, keys, dynamic=dynamic, settings=settings)
        if hive or cfg.landing_format == "avro":
            catalog.require_avro(spark, target)
        return n

    written = _built(spark, cfg, names.LANDING, table.name, build)
    report = StepReport(names.LANDING, table.name, written, content=content())
    return _read_back(report, _landed(spark, cfg, table, source))


def _landed(
    spark: SparkSession, cfg: LakeConfig, table: TableConfig, source: DataFrame
) -> DataFrame:
    """Landing rows of the last load, with columns in the order of ``source``."""
    landing = load(spark, cfg, names.LANDING, table)
    landing = landing.select(*[F.col(f"`{name.lower()}`") for name in source.columns])
    keys = [name.lower() for name in table.partitioned_by]
    if not (keys and table.dynamic_partitions):
        return landing
    # Other partitions are older.
    loaded = source.select(*[F.col(name).alias(f"_{name}") for name in keys]).distinct()
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in keys]
    return landing.join(loaded, reduce(and_, same), "left_semi")


def _store_parquet(
    spark: SparkSession, cfg: LakeConfig, layer: str, name: str, df: DataFrame
) -> StepReport:
    _prepare(spark, cfg, layer)
    df, content = _watched(df, cfg)
    if cfg.use_catalog:

        def build(target: str, folder: str) -> int:
            return writers.save_parquet_table(df, target, folder if cfg.reset else None)

        written = _built(spark, cfg, layer, name, build)
    else:
        written = writers.write_folder(df, cfg.table_path(layer, name))
    return StepReport(layer, name, written, content=content())


def build_curated(spark: SparkSession, cfg: LakeConfig, table: TableConfig) -> StepReport:
    """Landing into the cleaned table, whose rows are counted once more."""
    curated = curated_postings(load(spark, cfg, names.LANDING, table))
    report = _store_parquet(spark, cfg, names.CURATED, table.name, curated)
    return _read_back(report, load(spark, cfg, names.CURATED, table))


def build_functional(
    spark: SparkSession, cfg: LakeConfig, table: TableConfig, landing_rows: int | None = None
) -> StepReport:
    """Landing into the aggregate, whose groups have to hold all rows of landing;
    ``landing_rows`` is their number, if known."""
    landing = load(spark, cfg, names.LANDING, table)
    keys = [name.lower() for name in table.partitioned_by]
    with scratch(spark):
        if cfg.incremental and keys and table.dynamic_partitions:
            folder = cfg.table_path(names.LANDING, table.name)
            if cfg.use_catalog:
                folder = publish.location_of(spark, cfg.table(names.LANDING, table.name))
            kept = cfg.table_path(names.FUNCTIONAL, f"{cfg.aggregate(table)}_states")
            states.refresh_states(landing, folder, kept, keys)
            aggregate = states.impact_from_states(landing, folder, kept, keys)
        else:
            aggregate = impact_aggregate(landing, known_rows=landing_rows)
        report = _store_parquet(spark, cfg, names.FUNCTIONAL, cfg.aggregate(table), aggregate)
    functional = load(spark, cfg, names.FUNCTIONAL, table)
    counted = functional.agg(F.sum("job_count")).first()[0] or 0
    if landing_rows is not None and counted != landing_rows:
        _refuse(
            f"{names.FUNCTIONAL} {report.table}: groups of {counted} rows, but landing has "
            f"{landing_rows}",
            cfg,
        )
    return _read_back(report, functional)


def export_gold(spark: SparkSession, cfg: LakeConfig, table: TableConfig) -> StepReport:
    """Functional table to CSV; an empty table is refused."""
    functional = refuse_empty(load(spark, cfg, names.FUNCTIONAL, table), "functional table")
    name = cfg.aggregate(table)
    path = cfg.table_path(names.GOLD, f"{name}_csv")
    if cfg.plain_csv:
        functional = _plain(functional)
    rows, content = _watched(functional, cfg)
    written = writers.export_csv(rows, path, plain=cfg.plain_csv, single_file=cfg.single_csv)
    report = StepReport(names.GOLD, f"{name}_csv", written, content=content())
    stored = readers.read_csv_export(spark, path, FUNCTIONAL, plain=cfg.plain_csv)
    return _read_back(report, stored)


def _plain(df: DataFrame) -> DataFrame:
    """Rows as a plain export can hold them: an empty text is null."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[F.nullif(F.col(c), F.lit("")).alias(c) if c in texts else F.col(c) for c in df.columns]
    )


def publish_documents(spark: SparkSession, cfg: LakeConfig, table: TableConfig) -> StepReport:
    """Functional table to the document collection, straight from the table."""
    functional = refuse_empty(load(spark, cfg, names.FUNCTIONAL, table), "functional table")
    name = cfg.aggregate(table)
    in_files = cfg.document_format in ("json", documents.NAME)
    path = cfg.table_path(names.GOLD, name) if in_files else None
    options = cfg.document_options
    rows, content = _watched(functional, cfg)
    written = writers.write_documents(rows, cfg.document_format, path=path, options=options)
    stored = readers.read_documents(
        spark,
        cfg.document_format,
        path=path,
        schema=FUNCTIONAL if path else None,
        options=options,
    )
    # A store may hand out other columns beside, in another order and of wider types.
    stored = stored.select(*[F.col(f.name).cast(f.dataType) for f in FUNCTIONAL.fields])
    return _read_back(StepReport(names.GOLD, name, written, content=content()), stored)


STEPS = (
    (names.WORKLOAD, ingest_raw),
    (names.LANDING, build_landing),
    (names.FUNCTIONAL, build_functional),
    (names.CURATED, build_curated),
    (names.GOLD, export_gold),
    (names.GOLD, publish_documents),
)


def _settings_of(step, cfg: LakeConfig, table: TableConfig) -> dict:
    """What of the settings decides the result of a step."""
    if step is ingest_raw:
        return {
            "schema": table.schema.json(),
            "multi_line": cfg.multi_line_source,
            "quote_escape": table.quote_escape,
            "keep_rejects": cfg.keep_rejects,
            "most_malformed_rows": cfg.most_malformed_rows,
        }
    if step is build_landing:
        return {
            "format": cfg.landing_format,
            "keys": table.partitioned_by,
            "dynamic": table.dynamic_partitions,
            "contract": table.contract_path,
        }
    if step is export_gold:
        return {"plain": cfg.plain_csv, "single": cfg.single_csv}
    if step is publish_documents:
        return {"format": cfg.document_format, "options": dict(cfg.document_options)}
    return {}


def _folder(spark: SparkSession, cfg: LakeConfig, layer: str, table: TableConfig) -> str:
    """Where the table of a layer is stored now."""
    name = _stored_name(cfg, layer, table)
    target = cfg.table(layer, name)
    if cfg.use_catalog and spark.catalog.tableExists(target):
        return publish.location_of(spark, target)
    return cfg.table_path(layer, name)


def _inputs(spark: SparkSession, cfg: LakeConfig, step, table: TableConfig) -> str:
    """A hash of what a step reads and how."""
    if step is ingest_raw:
        read = cfg.source(table)
    else:
        layer = {build_landing: names.WORKLOAD, build_functional: names.LANDING,
                 build_curated: names.LANDING}.get(step, names.FUNCTIONAL)
        read = _folder(spark, cfg, layer, table)
    return inputs_hash(
        read=folder_version(spark, read),
        settings=_settings_of(step, cfg, table),
        use_catalog=cfg.use_catalog,
        verify=cfg.verify,
    )


def _output(spark: SparkSession, cfg: LakeConfig, layer: str, step, table: TableConfig) -> str:
    if step is export_gold:
        return cfg.table_path(names.GOLD, f"{cfg.aggregate(table)}_csv")
    if step is publish_documents:
        return cfg.table_path(names.GOLD, cfg.aggregate(table))
    return _folder(spark, cfg, layer, table)


def run_pipeline(
    spark: SparkSession, cfg: LakeConfig, *, resume: bool = False
) -> list[StepReport]:
    """Run every step over every configured table, layer by layer.

    With ``resume`` finished steps are written to a journal, and those are left out whose inputs
    and settings are the ones of the last run and whose output is as that run left it.
    """
    journal = Journal(spark, f"{cfg.layer_path('journal')}/steps")
    reports, landed, copied = [], {}, {}
    for layer, step in STEPS:
        for table in cfg.tables:
            name, inputs, told = f"{step.__name__} {table.name}", "", None
            if resume:
                inputs = _inputs(spark, cfg, step, table)
                output = _output(spark, cfg, layer, step, table)
                told = journal.finished(name, inputs, output)
            if told is not None:
                report = as_report(StepReport, told)
            elif step is build_functional:
                report = step(spark, cfg, table, landing_rows=landed[table.name])
            else:
                report = step(spark, cfg, table)
            if step is build_landing:
                # Dynamic partitions leave older rows in the table beside the written ones.
                whole = not (table.partitioned_by and table.dynamic_partitions)
                landed[table.name] = report.rows_written if whole else None
            refuse_mismatch(report, cfg)
            if step is build_landing:
                refuse_difference(copied[table.name], report, cfg)
            if resume and told is None and report.matches:
                output = _output(spark, cfg, layer, step, table)
                journal.record(name, inputs, output, report)
            copied[table.name] = report
            reports.append(report)
        if cfg.reset and cfg.use_catalog and layer != names.GOLD:
            made = [_stored_name(cfg, layer, table) for table in cfg.tables]
            publish.drop_others(spark, cfg.database(layer), made)
    return reports
