"""The document collection: what it keeps, and writes that end half-way."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from jobstrata.sources import documents, readers, writers

SCHEMA = "name string, n long, i int, x double, ok boolean"
ROWS = [
    ("a, \"b\"\nc\\d é", 1, -1, 0.1, True),
    ("", 2**62, None, 1e300, False),
    (None, None, None, None, None),
    ("\\N", 0, 7, -0.0, None),
]


@pytest.fixture
def collection(spark, folder):
    documents.register(spark)
    return os.path.join(folder, "c")


def rows(spark, values=ROWS):
    return spark.createDataFrame(values, SCHEMA)


def held(spark, path):
    found = readers.read_documents(spark, documents.NAME, path=path, schema=SCHEMA)
    return sorted(map(tuple, found.collect()), key=str)


def files(path):
    return {os.path.basename(f) for f in glob.glob(f"{path}/part-*")}


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_documents_read_back(spark, collection, prefix):
    path = prefix + collection
    n = writers.write_documents(rows(spark).repartition(3), documents.NAME, path=path)
    assert n == 4 and held(spark, path) == sorted(ROWS, key=str)
    assert writers.write_documents(rows(spark, ROWS[:1]), documents.NAME, path=path) == 1
    assert held(spark, path) == ROWS[:1] and len(files(collection)) == 1


def test_append_empty_and_bounded_files(spark, collection):
    writer = rows(spark).coalesce(1).write.format(documents.NAME).option("file_bytes", 1)
    writer.mode("append").save(collection)
    writer.mode("append").save(collection)
    assert held(spark, collection) == sorted(ROWS * 2, key=str) and len(files(collection)) == 8
    found = readers.read_documents(spark, documents.NAME, path=collection, schema=SCHEMA)
    assert found.rdd.getNumPartitions() == 8
    writers.write_documents(rows(spark, []), documents.NAME, path=collection)
    assert held(spark, collection) == [] and not files(collection)
    assert held(spark, collection + "-none") == []


def test_an_aborted_write_leaves_the_old_collection(spark, collection):
    writers.write_documents(rows(spark), documents.NAME, path=collection)
    before = files(collection)
    many = spark.range(200).repartition(4).select(
        F.lit("x").alias("name"),
        F.when(F.col("id") == 150, F.raise_error(F.lit("half-way")).cast("long"))
        .otherwise(F.col("id"))
        .alias("n"),
    )
    with pytest.raises(Exception, match="half-way"):
        writers.write_documents(many, documents.NAME, path=collection)
    assert held(spark, collection) == sorted(ROWS, key=str)
    assert before <= files(collection)
    # What lost tasks have left does not count.
    with open(os.path.join(collection, "part-lost.jsonl"), "w") as out:
        out.write(json.dumps({"name": "lost"}) + "\n")
    assert held(spark, collection) == sorted(ROWS, key=str)


def test_commit_and_abort_of_messages(tmp_path):
    from pyspark.sql import types as T

    path = str(tmp_path / "c")
    schema = T.StructType([T.StructField("n", T.LongType())])
    import pyarrow as pa

    def batch(*n):
        return pa.RecordBatch.from_pydict({"n": list(n)})

    first = documents.DocumentWriter(path, schema, True, 1 << 20)
    first.commit([first.write(iter([batch(1, 2)])), None, first.write(iter([]))])
    second = documents.DocumentWriter(path, schema, True, 1 << 20)
    message = second.write(iter([batch(3)]))
    assert len(files(path)) == 2
    second.abort([message, None])
    reader = documents.DocumentReader(path, schema)
    found = [b.to_pylist() for p in reader.partitions() for b in reader.read(p)]
    assert found == [[{"n": 1}, {"n": 2}]] and len(files(path)) == 1

    def failing():
        yield batch(5)
        raise RuntimeError("lost")

    bounded = documents.DocumentWriter(path, schema, True, 1)
    with pytest.raises(RuntimeError):
        bounded.write(failing())
    assert len(files(path)) == 1


def test_what_documents_cannot_hold(spark, collection):
    with pytest.raises(Exception, match="can't hold d"):
        odd = spark.sql("SELECT 1 AS n, DATE'2020-01-01' AS d")
        writers.write_documents(odd, documents.NAME, path=collection)
    with pytest.raises(Exception, match="JSON compliant"):
        nan = spark.sql("SELECT DOUBLE('NaN') AS x")
        writers.write_documents(nan, documents.NAME, path=collection)


def test_schema_is_inferred(spark, collection):
    writers.write_documents(rows(spark, ROWS[:1]), documents.NAME, path=collection)
    found = spark.read.format(documents.NAME).load(collection)
    assert dict(found.dtypes) == {
        "name": "string", "n": "bigint", "i": "bigint", "x": "double", "ok": "boolean",
    }


def test_a_pipeline_publishes_to_it(spark, folder):
    from jobstrata.config import LakeConfig
    from jobstrata.contract import RAW_COLUMNS
    from jobstrata.plans.pipeline import run_pipeline

    with open(os.path.join(folder, "job_postings.csv"), "w") as out:
        out.write(",".join(RAW_COLUMNS) + "\n" + ",".join(str(c) for c in range(22)) + "\n")
    cfg = LakeConfig(
        folder, base_path=folder, use_catalog=False, landing_format="parquet",
        document_format=documents.NAME,
    )
    assert run_pipeline(spark, cfg)[-1].matches
