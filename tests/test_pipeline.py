import os
import tempfile
from collections import Counter
from dataclasses import replace

import pytest

from jobstrata import config
from jobstrata.config import LakeConfig, TableConfig
from jobstrata.contract import FUNCTIONAL
from jobstrata.operators.aggregates import impact_aggregate
from jobstrata.operators.projections import curated_postings
from jobstrata.plans.pipeline import export_gold, load, run_pipeline
from jobstrata.plans.standin import postings
from jobstrata.sources import readers

from small_data import SMALL_DATA


@pytest.fixture(scope="module")
def source(spark):
    """Whole stand-in postings as source text."""
    path = tempfile.mkdtemp(prefix="run-")
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    text = postings(spark, SMALL_DATA).write.options(header=True, **blanks)
    text.csv(os.path.join(path, "job_postings.csv"))
    return path


@pytest.fixture(scope="module")
def expected(spark):
    """Rows of every layer, computed straight from the stand-in."""
    raw = postings(spark, SMALL_DATA)
    return {
        "raw": _rows(raw),
        "curated": _rows(curated_postings(raw)),
        "functional": _rows(impact_aggregate(raw, known_rows=6000)),
    }


def _rows(df):
    return df.columns, Counter(tuple(row) for row in df.collect())


def _check(spark, cfg, expected, table):
    reports = run_pipeline(spark, cfg)
    assert [report.layer for report in reports] == [
        config.WORKLOAD, config.LANDING, config.FUNCTIONAL, config.CURATED, config.GOLD,
        config.GOLD,
    ]
    assert all(report.matches for report in reports)
    columns, rows = expected["raw"]
    assert [report.rows_written for report in reports[:2]] == [rows.total()] * 2
    assert reports[0].malformed_rows == 0
    assert reports[3].rows_read_back == rows.total()
    landing = load(spark, cfg, config.LANDING, table)
    assert _rows(load(spark, cfg, config.WORKLOAD, table)) == expected["raw"]
    assert _rows(landing.select(*columns)) == expected["raw"]
    assert _rows(load(spark, cfg, config.CURATED, table)) == expected["curated"]
    assert _rows(load(spark, cfg, config.FUNCTIONAL, table)) == expected["functional"]
    gold = cfg.table_path(config.GOLD, cfg.aggregate(table))
    export = readers.read_csv_export(spark, f"{gold}_csv", FUNCTIONAL, plain=cfg.plain_csv)
    assert _rows(export) == expected["functional"]
    documents = readers.read_documents(spark, path=gold, schema=FUNCTIONAL)
    assert _rows(documents) == expected["functional"]
    return reports


def test_folders_twice(spark, folder, source, expected):
    table = TableConfig(partitioned_by=("posting_year",))
    cfg = LakeConfig(
        source, base_path=folder, tables=(table,), use_catalog=False, landing_format="parquet",
        single_csv=True,
    )
    assert _check(spark, cfg, expected, table) == _check(spark, cfg, expected, table)


def test_catalog_with_reset(spark, folder, source, expected):
    table = TableConfig()
    cfg = LakeConfig(
        source, env="Pipe", base_path=folder, tables=(table,), landing_format="parquet",
        reset=True, plain_csv=True,
    )
    assert _check(spark, cfg, expected, table) == _check(spark, cfg, expected, table)
    assert spark.catalog.databaseExists("pipe_landing")
    for layer in (config.WORKLOAD, config.LANDING, config.CURATED, config.FUNCTIONAL):
        spark.sql(f"DROP DATABASE {cfg.database(layer)} CASCADE")


def _text_source(folder, name, records):
    from jobstrata.contract import RAW_COLUMNS

    lines = [RAW_COLUMNS, *[[record.get(c, "") for c in RAW_COLUMNS] for record in records]]
    with open(os.path.join(folder, name), "w") as out:
        out.write("".join(",".join(line) + "\n" for line in lines))


def test_several_tables(spark, folder):
    _text_source(folder, "a.csv", [{"job_id": "1", "industry": "it", "salary_usd": "10"}] * 3)
    _text_source(folder, "b.csv", [{"job_id": "2", "industry": "it", "salary_usd": "20"}] * 2)
    tables = (TableConfig("First", "a.csv"), TableConfig("Second", "b.csv"))
    cfg = LakeConfig(
        folder, base_path=folder, tables=tables, use_catalog=False, landing_format="parquet"
    )
    reports = run_pipeline(spark, cfg)
    assert [report.rows_written for report in reports] == [3, 2, 3, 2, 1, 1, 3, 2, 1, 1, 1, 1]
    medians = [
        load(spark, cfg, config.FUNCTIONAL, table).first().median_salary_usd for table in tables
    ]
    assert medians == [10.0, 20.0]


@pytest.mark.parametrize("use_catalog", [False, True])
def test_landing_keeps_partitions_that_are_not_in_the_input(spark, folder, use_catalog):
    from jobstrata.plans.pipeline import build_landing, ingest_raw

    table = TableConfig(partitioned_by=("industry",))
    cfg = LakeConfig(
        folder, env="parts", base_path=folder, tables=(table,), use_catalog=use_catalog,
        landing_format="parquet",
    )
    loads = [
        [{"job_id": "1", "industry": "it"}, {"job_id": "2", "industry": "007"}],
        [{"job_id": "3", "industry": "it"}, {"job_id": "4", "industry": "law"}],
    ]
    for records in loads:
        _text_source(folder, "job_postings.csv", records)
        ingest_raw(spark, cfg, table)
        assert build_landing(spark, cfg, table).rows_written == 2
    landing = load(spark, cfg, config.LANDING, table).select("job_id", "industry")
    assert sorted(map(tuple, landing.collect())) == [("2", "007"), ("3", "it"), ("4", "law")]
    if use_catalog:
        spark.sql("DROP DATABASE parts_workload CASCADE")
        spark.sql("DROP DATABASE parts_landing CASCADE")


def test_wrong_header_is_refused(spark, folder):
    os.makedirs(os.path.join(folder, "in"))
    with open(os.path.join(folder, "in", "job_postings.csv"), "w") as out:
        out.write("job_id,country\n1,x\n")
    cfg = LakeConfig(os.path.join(folder, "in"), base_path=folder, use_catalog=False)
    with pytest.raises(ValueError, match="2 columns, 22 expected"):
        run_pipeline(spark, cfg)


@pytest.mark.parametrize("multi_line", [False, True])
def test_the_header_of_every_file_counts(spark, folder, multi_line):
    from jobstrata.contract import RAW_COLUMNS
    from jobstrata.plans.pipeline import ingest_raw

    swapped = list(RAW_COLUMNS)
    swapped[2:4] = swapped[3], swapped[2]
    for name, header in (("a.csv", RAW_COLUMNS), ("b.csv", swapped)):
        os.makedirs(os.path.join(folder, "in"), exist_ok=True)
        with open(os.path.join(folder, "in", name), "w") as out:
            out.write(",".join(header) + "\n" + ",".join(f"v{i}" for i in range(22)) + "\n")
    table = TableConfig(source_file=os.path.join(folder, "in"))
    cfg = LakeConfig(
        base_path=folder, tables=(table,), use_catalog=False, multi_line_source=multi_line
    )
    with pytest.raises(Exception, match="(?i)header"):
        ingest_raw(spark, cfg, table)


def test_rejects_are_kept_and_limited(spark, folder):
    from jobstrata.contract import RAW_COLUMNS
    from jobstrata.plans.pipeline import ingest_raw

    lines = [RAW_COLUMNS, ["short"] * 3, ["v"] * 22, ["long"] * 23]
    with open(os.path.join(folder, "job_postings.csv"), "w") as out:
        out.write("".join(",".join(line) + "\n" for line in lines))
    cfg = LakeConfig(folder, base_path=folder, use_catalog=False, keep_rejects=True)
    assert ingest_raw(spark, cfg, cfg.tables[0]).malformed_rows == 2
    path = cfg.table_path(config.WORKLOAD, "job_postings_rejects")
    kept = readers.read_lossless_csv(spark, path, "line string, job_id string")
    assert {r.line.split(",")[0] for r in kept.collect()} == {"short", "long"}
    with pytest.raises(ValueError, match="2 malformed rows, at most 1"):
        ingest_raw(spark, replace(cfg, most_malformed_rows=1), cfg.tables[0])


@pytest.mark.parametrize("escape, value", [("\\", '"say ""hi"", yes"'), ('"', 'say "hi", yes')])
def test_doubled_quotes(spark, folder, escape, value):
    from jobstrata.contract import RAW_COLUMNS
    from jobstrata.plans.pipeline import ingest_raw

    row = ["1", '"say ""hi"", yes"', *["v"] * 20]
    with open(os.path.join(folder, "job_postings.csv"), "w") as out:
        out.write(",".join(RAW_COLUMNS) + "\n" + ",".join(row) + "\n")
    table = TableConfig(quote_escape=escape)
    cfg = LakeConfig(folder, base_path=folder, tables=(table,), use_catalog=False)
    ingest_raw(spark, cfg, table)
    got = load(spark, cfg, config.WORKLOAD, table).first()
    assert (got[1] == value) == (escape == '"')


def test_lost_rows_stop_the_run(spark, folder, monkeypatch):
    from jobstrata.sources import writers

    whole = writers.write_folder

    def lossy(df, path, *args, **kwargs):
        written = whole(df, path, *args, **kwargs)
        if "curated" in path:
            whole(df.limit(1), path)
        return written

    _text_source(folder, "job_postings.csv", [{"job_id": str(i)} for i in range(3)])
    cfg = LakeConfig(folder, base_path=folder, use_catalog=False, landing_format="parquet")
    monkeypatch.setattr(writers, "write_folder", lossy)
    with pytest.raises(ValueError, match="3 rows written, 1 found"):
        run_pipeline(spark, cfg)
    with pytest.warns(UserWarning, match="3 rows written, 1 found"):
        run_pipeline(spark, replace(cfg, on_mismatch="warn"))


def test_row_bound_only_after_whole_writes(spark, folder, monkeypatch):
    """A daily load beside older partitions gives no bound of the rows in landing."""
    from jobstrata.plans import pipeline

    bounds = []
    aggregate = pipeline.impact_aggregate
    monkeypatch.setattr(
        pipeline,
        "impact_aggregate",
        lambda df, known_rows=None: bounds.append(known_rows) or aggregate(df),
    )
    _text_source(folder, "job_postings.csv", [{"job_id": "1", "industry": "it"}])
    for table in (
        TableConfig(partitioned_by=("industry",)),
        TableConfig(partitioned_by=("industry",), dynamic_partitions=False),
        TableConfig(),
    ):
        cfg = LakeConfig(
            folder,
            base_path=os.path.join(folder, str(len(bounds))),
            tables=(table,),
            use_catalog=False,
            landing_format="parquet",
        )
        run_pipeline(spark, cfg)
    assert bounds == [None, 1, 1]


@pytest.mark.parametrize("use_catalog", [False, True])
def test_rows_of_the_wrong_length_are_counted(spark, folder, use_catalog):
    from jobstrata.contract import RAW_COLUMNS
    from jobstrata.plans.pipeline import ingest_raw

    full = [f"v{i}" for i in range(22)]
    lines = [list(RAW_COLUMNS), full, full[:21], [*full, "extra"], full]
    with open(os.path.join(folder, "job_postings.csv"), "w") as out:
        out.write("".join(",".join(line) + "\n" for line in lines))
    cfg = LakeConfig(folder, env="arity", base_path=folder, use_catalog=use_catalog)
    report = ingest_raw(spark, cfg, cfg.tables[0])
    assert (report.rows_written, report.malformed_rows) == (4, 2)
    stored = load(spark, cfg, config.WORKLOAD, cfg.tables[0])
    assert stored.columns == list(RAW_COLUMNS)
    assert stored.where("industry_ai_adoption_stage IS NULL").count() == 1
    if use_catalog:
        spark.sql("DROP DATABASE arity_workload CASCADE")


def test_empty_gold_is_refused(spark, folder):
    cfg = LakeConfig("unused", base_path=folder, use_catalog=False)
    path = cfg.table_path(config.FUNCTIONAL, cfg.aggregate_name)
    spark.createDataFrame([], FUNCTIONAL).write.parquet(path)
    with pytest.raises(ValueError, match="functional table is empty"):
        export_gold(spark, cfg, cfg.tables[0])


def test_names():
    cfg = LakeConfig("in", env="QA", base_path="/data/", tables=(TableConfig(), TableConfig("B")))
    assert cfg.table(config.LANDING, "Job_Postings") == "qa_landing.job_postings"
    assert cfg.table_path(config.CURATED, "T") == "/data/hadoop/datalake/qa_curated/t"
    assert [cfg.aggregate(t) for t in cfg.tables] == ["impact_aggregated", "b_impact_aggregated"]
