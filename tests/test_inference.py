"""Inferred types against Spark's own inference, and their merging over parts."""

import os

import pytest

from jobstrata.operators.inference import infer_types, inferred_schema
from jobstrata.sources import readers, writers

COLUMNS = {
    "int": ["1", "-20", "+3", "", None],
    "bigint": ["1", "3000000000", None],
    "double": ["1", "2.5", "3e4", ".5"],
    "wide": ["1", "99999999999999999999"],
    "special": ["NaN", "1.0", "-Infinity"],
    "boolean": ["true", "FALSE", None],
    "date": ["2020-01-31", "1999-12-01"],
    "timestamp": ["2020-01-31 10:00:00", "2020-01-31T10:00:01.5"],
    "bad_date": ["2020-01-31", "2020-02-31"],
    "mixed": ["1", "true"],
    "text": ["1", "x"],
    "empty": [None, "", None],
}
WANT = {
    "int": "int", "bigint": "bigint", "double": "double", "wide": "double", "special": "double",
    "boolean": "boolean", "date": "date", "timestamp": "timestamp", "bad_date": "string",
    "mixed": "string", "text": "string", "empty": "string",
}


@pytest.fixture
def texts(spark):
    n = max(map(len, COLUMNS.values()))
    rows = list(zip(*[[*v, *[None] * (n - len(v))] for v in COLUMNS.values()]))
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLUMNS))


def test_narrowest_types(texts):
    rows = infer_types(texts).collect()
    assert {r.column_name: r.type for r in rows} == WANT
    assert [r.position for r in rows] == list(range(1, len(COLUMNS) + 1))
    assert {r.column_name: r.filled for r in rows}["int"] == 3


def test_as_spark_infers(spark, texts, folder):
    path = os.path.join(folder, "t")
    texts.coalesce(1).write.options(header=True).csv(path)
    spark_types = dict(spark.read.options(header=True, inferSchema=True).csv(path).dtypes)
    # An integer beyond 64 bits is a decimal there.
    assert {**spark_types, "wide": "double"} == WANT


def test_an_export_read_without_schema(spark, folder):
    path = os.path.join(folder, "t")
    df = spark.sql("SELECT 1 AS a, 2.5D AS b, 'x, y' AS c, CAST(NULL AS STRING) AS d, '2020' AS e")
    for plain in (False, True):
        writers.export_csv(df, path, plain=plain)
        found = readers.read_csv_export(spark, path, None, plain=plain)
        assert found.dtypes == [
            ("a", "int"), ("b", "double"), ("c", "string"), ("d", "string"), ("e", "int"),
        ]
        assert tuple(found.first()) == (1, 2.5, "x, y", None, 2020)


def test_names_and_empty_tables(spark):
    odd = spark.createDataFrame([("1", "x")], "`a.b` string, `n_0` string")
    assert inferred_schema(odd).simpleString() == "struct<a.b:int,n_0:string>"
    assert {r.type for r in infer_types(odd.limit(0)).collect()} == {"string"}
