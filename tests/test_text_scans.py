"""Text read in splits, by each file's own header, and runs that go on behind a failure."""

import os
import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import types as T

from jobstrata import config
from jobstrata.config import LakeConfig
from jobstrata.contract import RAW_COLUMNS
from jobstrata.operators import quality
from jobstrata.plans import pipeline
from jobstrata.sources import aligned_text, documents, split_text

ABC = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b", "c")])


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as out:
        out.write(text)


def counted(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture
def small_splits(spark):
    values = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("escape", ["\\", '"'])
def test_splits_equal_the_whole_file_reader(spark, folder, small_splits, escape):
    draw = random.Random(2)
    quote = {"\\": '\\"', '"': '""'}[escape]
    parts = ["x", " y", quote, ",", "\n", "\r\n", "", "é", "\n\n", "long " * 9]
    for file in range(3):
        lines = ['a,"b",c' if file else 'a,b,c']
        for _ in range(80):
            row = []
            for _ in range(draw.choice([3, 3, 3, 2, 4])):
                value = "".join(draw.choices(parts, k=draw.randrange(4)))
                plain = not set(value) & set('",\n\r\\')
                row.append(value if plain and draw.random() < 0.5 else f'"{value}"')
            lines.append(",".join(row))
        put(folder, f"{file}.csv", draw.choice(["\n", "\n", "\r\n"]).join(lines) + "\n" * file)
    want = quality.scan_with_arity(spark, folder, ABC, multi_line=True, quote_escape=escape)
    got = split_text.scan_in_splits(spark, folder, ABC, quote_escape=escape)
    assert counted(got) == counted(want)
    lines = spark.read.option("lineSep", "\n").text(folder)
    assert lines.rdd.getNumPartitions() > 20


def test_unclosed_and_endless_records_are_refused(spark, folder, monkeypatch):
    put(folder, "a.csv", 'a,b,c\n1,2,3\n4,"5\n6,7,8\n')
    with pytest.raises(Exception, match="not closed"):
        split_text.scan_in_splits(spark, folder, ABC).collect()
    monkeypatch.setattr(split_text, "MOST_LINES", 3)
    put(folder, "a.csv", 'a,b,c\n1,"\n\n\n\n",3\n')
    with pytest.raises(Exception, match="not closed"):
        split_text.scan_in_splits(spark, folder, ABC).collect()


def test_empty_files_and_headers_with_newlines(spark, folder):
    put(folder, "a.csv", "")
    put(folder, "b.csv", 'a,"b\nb",c\n1,2,3\n')
    put(folder, "c.csv", "a,b,c")
    got = split_text.scan_in_splits(spark, folder, ABC)
    assert counted(got) == {("1", "2", "3", None): 1}


def test_values_are_placed_by_name(spark, folder, small_splits):
    put(folder, "1.csv", "c,a,b\n" + "3,1,2\n" * 30)
    put(folder, "2.csv", 'A ,extra,"c"\n1,x,"3\n3"\n1,x\n')
    put(folder, "3.csv", 'b,"a, with comma",c,a\n2,y,3,1\n2,y,3\n')
    got = aligned_text.aligned_scan(spark, folder, ABC)
    rows = counted(got)
    assert rows[("1", "2", "3", None)] == 31
    assert rows[("1", None, "3\n3", None)] == 1
    assert rows[("1", None, None, "1,x")] == 1 and rows[(None, "2", "3", "2,y,3")] == 1
    told = {os.path.basename(r.file): r for r in aligned_text.file_headers(spark, folder, ABC).collect()}
    assert told["1.csv"].places == [1, 2, 0] and told["1.csv"].missing == []
    assert (told["2.csv"].missing, told["2.csv"].unknown) == (["b"], ["extra"])
    assert told["3.csv"].unknown == ["a, with comma"]


def test_names_given_twice_are_refused(spark, folder, monkeypatch):
    put(folder, "1.csv", "a,b,c,b\n1,2,3,4\n")
    with pytest.raises(ValueError, match="b given twice"):
        aligned_text.aligned_scan(spark, folder, ABC)
    put(folder, "1.csv", "a,x,c,x\n1,2,3,4\n")
    monkeypatch.setattr(aligned_text, "BROADCAST_BYTES", -1)
    assert counted(aligned_text.aligned_scan(spark, folder, ABC)) == {("1", None, "3", None): 1}


def _source(folder, records=3, order=RAW_COLUMNS):
    lines = [order, *[[f'"{c}\n{i}"' for c in order] for i in range(records)]]
    put(folder, "job_postings.csv", "".join(",".join(line) + "\n" for line in lines))


def test_a_pipeline_over_broken_lines_and_other_orders(spark, folder):
    source = os.path.join(folder, "in")
    for align in (False, True):
        _source(source, order=RAW_COLUMNS[::-1] if align else RAW_COLUMNS)
        cfg = LakeConfig(
            source, base_path=os.path.join(folder, str(align)), use_catalog=False,
            landing_format="parquet", multi_line_source=not align, align_headers=align,
        )
        assert all(r.matches for r in pipeline.run_pipeline(spark, cfg))
        row = pipeline.load(spark, cfg, config.LANDING, cfg.tables[0]).orderBy("job_id").first()
        assert row.job_id == "job_id\n0" and row.city == "city\n0"


def _spied(monkeypatch):
    calls = []

    def spied(step):
        def run(*args, **kwargs):
            calls.append(step.__name__)
            return step(*args, **kwargs)

        run.__name__ = step.__name__
        return run

    # Steps are told apart by identity, so their names are spied where they do their work.
    for name in ("_scanned", "_landed", "curated_postings", "impact_aggregate"):
        monkeypatch.setattr(pipeline, name, spied(getattr(pipeline, name)))
    return calls


@pytest.mark.parametrize("use_catalog", [False, True])
def test_finished_steps_are_not_run_twice(spark, folder, monkeypatch, use_catalog):
    put(folder, "job_postings.csv", ",".join(RAW_COLUMNS) + "\n" + ",".join(["1"] * 22) + "\n")
    cfg = LakeConfig(
        folder, env="again", base_path=folder, use_catalog=use_catalog, landing_format="parquet",
        document_format=documents.NAME,
    )
    calls = _spied(monkeypatch)
    all_steps = ["_scanned", "_landed", "impact_aggregate", "curated_postings"]
    with pytest.raises(Exception):
        pipeline.run_pipeline(spark, replace(cfg, document_format="no-such-format"), resume=True)
    assert calls == all_steps
    calls.clear()
    first = pipeline.run_pipeline(spark, cfg, resume=True)
    assert calls == [] and len(first) == 6
    assert pipeline.run_pipeline(spark, cfg, resume=True) == first and calls == []
    # A changed setting invalidates its own step and what reads its output.
    pipeline.run_pipeline(spark, replace(cfg, plain_csv=True), resume=True)
    assert calls == []
    # A changed input invalidates all.
    put(folder, "job_postings.csv", ",".join(RAW_COLUMNS) + "\n" + ",".join(["22"] * 22) + "\n")
    pipeline.run_pipeline(spark, cfg, resume=True)
    assert calls == all_steps
    calls.clear()
    # So does an output that is no longer what the step left.
    curated = pipeline._folder(spark, cfg, config.CURATED, cfg.tables[0])
    for name in os.listdir(curated.removeprefix("file:")):
        os.remove(os.path.join(curated.removeprefix("file:"), name))
    pipeline.run_pipeline(spark, cfg, resume=True)
    assert calls == ["curated_postings"]
    calls.clear()
    pipeline.run_pipeline(spark, cfg)
    assert calls == all_steps
    if use_catalog:
        for layer in (config.WORKLOAD, config.LANDING, config.CURATED, config.FUNCTIONAL):
            spark.sql(f"DROP DATABASE {cfg.database(layer)} CASCADE")


def test_schema_listing_and_preview(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "n int, `a.b` string")
    listed = sorted(map(tuple, quality.schema_listing(df).collect()))
    assert listed == [("a.b", "string", 2, 1), ("n", "int", 1, 2)]
    assert [r.n for r in quality.preview_rows(df, ["a.b"]).collect()] == [1, 2]
    assert quality.preview_rows(df.limit(0), ["n"]).count() == 0
