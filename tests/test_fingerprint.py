"""Fingerprints of contents, and layers that hold other than what was written to them."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from jobstrata import config
from jobstrata.config import LakeConfig, TableConfig
from jobstrata.operators.fingerprint import Fingerprint, comparison, fingerprint_of, watched
from jobstrata.plans import pipeline

SCHEMA = "a string, b string, n double"
ROWS = [("x", "y", 1.0), ("x", None, 2.0), (None, "x", 2.0), ("", "y", None), ("x", "y", 1.0)]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_order_and_partitions_do_not_count(spark):
    whole = fingerprint_of(table(spark, ROWS))
    assert whole.rows == 5
    assert fingerprint_of(table(spark, ROWS[::-1]).repartition(3)) == whole
    assert fingerprint_of(table(spark, [])) == Fingerprint(0, 0, 0)


@pytest.mark.parametrize(
    "other",
    [
        ROWS[:4],
        [*ROWS, ROWS[0]],
        [*ROWS[:4], ROWS[1]],
        [(b, a, n) for a, b, n in ROWS],
        [("x", "y", 1.5), *ROWS[1:]],
        [("x", "y", 2.0), ("x", None, 1.0), *ROWS[2:]],
        [*ROWS[:3], (None, "y", None), ROWS[4]],
        [ROWS[0], (None, "x", 2.0), ("x", None, 1.0), *ROWS[3:]],
    ],
)
def test_any_difference_counts(spark, other):
    assert fingerprint_of(table(spark, other)) != fingerprint_of(table(spark, ROWS))
    row = comparison(table(spark, ROWS), table(spark, other)).first()
    assert not row.contents_match and row.counts_match == (len(other) == 5)


def test_a_write_takes_the_fingerprint(spark, folder):
    df, taken = watched(table(spark, ROWS))
    df.write.parquet(os.path.join(folder, "t"))
    assert taken() == fingerprint_of(table(spark, ROWS))


def _source(folder):
    from jobstrata.contract import RAW_COLUMNS

    lines = [RAW_COLUMNS, *[[f"{c}{i}" for c in range(22)] for i in range(3)]]
    with open(os.path.join(folder, "job_postings.csv"), "w") as out:
        out.write("".join(",".join(line) + "\n" for line in lines))


@pytest.mark.parametrize("part", ["workload", "landing", "curated", "functional", "_csv", "gold"])
def test_a_sink_that_changes_one_value_is_refused(spark, folder, monkeypatch, part):
    """In every layer, by exchanging what one column of one row holds."""
    from jobstrata.sources import writers

    hit = []

    def spoiling(write):
        def run(df, *args, **kwargs):
            path = next((a for a in (*args, *kwargs.values()) if folder in str(a)), "")
            if part in path and ("_csv" in path) == (part == "_csv"):
                hit.append(path)
                name = df.columns[2]
                one = F.row_number().over(_first(df)) == 1
                changed = F.when(one, F.lit("other")).otherwise(F.col(name))
                df = df.withColumn(name, changed)
            return write(df, *args, **kwargs)

        return run

    for name in ("write_lossless_csv", "write_folder", "export_csv", "write_documents"):
        monkeypatch.setattr(writers, name, spoiling(getattr(writers, name)))
    _source(folder)
    cfg = LakeConfig(folder, base_path=folder, use_catalog=False, landing_format="parquet")
    with pytest.raises(ValueError, match="other values"):
        pipeline.run_pipeline(spark, cfg)
    assert hit
    with pytest.warns(UserWarning, match="other values"):
        pipeline.run_pipeline(spark, replace(cfg, on_mismatch="warn"))
    pipeline.run_pipeline(spark, replace(cfg, verify="count"))


def _first(df):
    from pyspark.sql.window import Window

    return Window.partitionBy(F.lit(1)).orderBy(*df.columns)


def test_every_step_is_read_back(spark, folder):
    _source(folder)
    for verify in ("content", "count"):
        cfg = LakeConfig(
            folder,
            base_path=os.path.join(folder, verify),
            use_catalog=False,
            landing_format="parquet",
            verify=verify,
            plain_csv=verify == "content",
        )
        reports = pipeline.run_pipeline(spark, cfg)
        assert len(reports) == 6 and all(r.matches for r in reports)
        assert all(r.rows_read_back == r.rows_written for r in reports)
        assert all((r.content is not None) == (verify == "content") for r in reports)
    assert not pipeline.StepReport("gold", "t", 3).matches


def test_landing_other_than_workload_is_refused(spark, folder, monkeypatch):
    _source(folder)
    cfg = LakeConfig(folder, base_path=folder, use_catalog=False, landing_format="parquet")
    load = pipeline.load

    def fewer(spark, cfg, layer, table):
        found = load(spark, cfg, layer, table)
        return found.where("job_id <> '00'") if layer == config.WORKLOAD else found

    pipeline.ingest_raw(spark, cfg, cfg.tables[0])
    calls = []

    def late(spark, cfg, layer, table):
        calls.append(layer)
        # The first read of the raw layer checks it; the second feeds landing.
        return load(spark, cfg, layer, table) if len(calls) == 1 else fewer(spark, cfg, layer, table)

    monkeypatch.setattr(pipeline, "load", late)
    with pytest.raises(ValueError, match="2 rows copied, which are not the 3"):
        pipeline.run_pipeline(spark, cfg)


def test_only_loaded_partitions_are_compared(spark, folder):
    _source(folder)
    keyed = TableConfig(partitioned_by=("country",))
    cfg = LakeConfig(
        folder, base_path=folder, tables=(keyed,), use_catalog=False, landing_format="parquet",
        incremental=True,
    )
    pipeline.run_pipeline(spark, cfg)
    with open(os.path.join(folder, "job_postings.csv"), "a") as out:
        out.write(",".join(f"{c}9" for c in range(22)) + "\n")
    text = open(os.path.join(folder, "job_postings.csv")).read().splitlines()
    with open(os.path.join(folder, "job_postings.csv"), "w") as out:
        out.write("\n".join([text[0], *text[2:]]) + "\n")
    reports = pipeline.run_pipeline(spark, cfg)
    assert reports[1].rows_read_back == 3
    functional = pipeline.load(spark, cfg, config.FUNCTIONAL, keyed)
    assert functional.agg(F.sum("job_count")).first()[0] == 4
