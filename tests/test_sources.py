import json
import os
import random
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from jobstrata import contract, workspace
from jobstrata.operators import quality
from jobstrata.sources import catalog, readers, writers

THREE = contract.string_schema(["a", "b", "c"])
AWKWARD = [
    ("x,y", 'say "hi"', "two\nlines"),
    ("", None, "  blanks  "),
    ("back\\slash", "é ñ 漢", "'single'"),
    (None, None, None),
    ('"', ",", "\\"),
    ("a\r\nb", "NULL", "null"),
]


def _rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def _text(folder, text, name="in.csv"):
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as out:
        out.write(text)
    return path


def test_raw_scan_pads_and_cuts_rows(spark, folder):
    path = _text(folder, 'a,b,c\n1,2,3\n4,5\n6,7,8,9\n"x,y", 01 ,\n')
    got = [tuple(row) for row in readers.read_raw_csv(spark, path, THREE).collect()]
    assert got == [
        ("1", "2", "3"), ("4", "5", None), ("6", "7", "8"), ("x,y", " 01 ", None)
    ]
    lines = quality.scan_with_arity(spark, path, THREE)
    found = [row.malformed_line for row in lines.collect()]
    assert found == [None, "4,5", "6,7,8,9", None]
    assert tuple(quality.row_arity(lines).first()) == (4, 2, 4)
    assert quality.header_problems(spark, path, THREE) == []
    assert quality.header_problems(spark, path, contract.string_schema(["a", "b", "d"]))


def test_quoted_newlines_need_multi_line(spark, folder):
    path = _text(folder, 'a,b,c\n1,"two\nlines",3\n')
    got = readers.read_raw_csv(spark, path, THREE, multi_line=True).collect()
    assert [tuple(row) for row in got] == [("1", "two\nlines", "3")]


def test_lossless_text(spark, folder):
    df = spark.createDataFrame(AWKWARD, THREE)
    path = os.path.join(folder, "text")
    for _ in range(2):
        writers.write_lossless_csv(df.repartition(2), path)
        assert _rows(readers.read_lossless_csv(spark, path, THREE)) == _rows(df)


def test_lossless_text_of_random_values(spark, folder):
    rng = random.Random(11)
    letters = '",\\\n\r\t \'N;|#é漢aB0'

    def value():
        return None if rng.random() < 0.1 else "".join(rng.choices(letters, k=rng.randint(0, 6)))

    data = [(value(), value(), value()) for _ in range(3000)]
    # The sentinel for null is the one text that does not survive.
    data = [tuple(None if v == readers.NULL_TEXT else v for v in row) for row in data]
    df = spark.createDataFrame(data, THREE)
    path = os.path.join(folder, "random")
    writers.write_lossless_csv(df, path)
    assert _rows(readers.read_lossless_csv(spark, path, THREE)) == sorted(data, key=repr)


def test_export_by_glob(spark, folder):
    df = spark.range(0, 50, 1, 4).selectExpr("id", "id / 4 AS share", "concat('n,', id) AS name")
    path = os.path.join(folder, "csv")

    def files():
        return len([name for name in os.listdir(path) if name.startswith("part-")])

    assert (writers.export_csv(df, path), files()) == (50, 4)
    assert (writers.export_csv(df, path, single_file=True), files()) == (50, 1)
    back = readers.read_csv_export(spark, f"{path}/part-*.csv", df.schema)
    assert _rows(back) == _rows(df)
    inferred = readers.read_csv_export(spark, f"{path}/part-*.csv", None)
    assert [kind for _, kind in inferred.dtypes] == ["int", "double", "string"]
    # One file is one file, beyond the size that parallel files are kept to as well.
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(writers, "ROWS_PER_TEXT_FILE", 10)
        assert (writers.export_csv(df, path, single_file=True), files()) == (50, 1)


def test_plain_export(spark, folder):
    schema = "k string, x double, t string"
    df = spark.createDataFrame([("a", 1.5, 'x,"y"\n'), (None, None, "z")], schema)
    path = os.path.join(folder, "plain")
    assert writers.export_csv(df, path, plain=True, single_file=True) == 2
    part = next(name for name in os.listdir(path) if name.startswith("part-"))
    with open(os.path.join(path, part)) as text:
        assert text.read() == 'k,x,t\na,1.5,"x,""y""\n"\n,,z\n'
    back = readers.read_csv_export(spark, path, df.schema, plain=True)
    assert _rows(back) == _rows(df)
    assert readers.read_csv_export(spark, path, None, plain=True).dtypes[1] == ("x", "double")


def test_documents(spark, folder):
    df = spark.createDataFrame([("a", 1, 0.5), (None, 2, None)], "k string, n int, x double")
    path = os.path.join(folder, "docs")
    for _ in range(2):
        writers.write_documents(df, path=path, options={"compression": "gzip"})
        assert _rows(readers.read_documents(spark, path=path, schema=df.schema)) == _rows(df)
    assert set(readers.read_documents(spark, path=path).columns) == {"k", "n", "x"}
    # Another connector is a matter of its name and options.
    where = {"path": os.path.join(folder, "other")}
    assert writers.write_documents(df, "orc", options=where) == 2
    assert _rows(readers.read_documents(spark, "orc", options=where)) == _rows(df)


def test_partitioned_folder_keeps_other_partitions(spark, folder):
    path = os.path.join(folder, "parts")
    first = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "n int, p string")
    writers.write_folder(first, path, partitioned_by=["p"])
    written = os.listdir(os.path.join(path, "p=y"))
    assert any(name.endswith(".snappy.parquet") for name in written)
    second = spark.createDataFrame([(9, "y"), (8, "z")], "n int, p string")
    for _ in range(2):
        assert writers.write_folder(second, path, partitioned_by=["p"]) == 2
        assert _rows(spark.read.parquet(path)) == [(1, "x"), (2, "x"), (8, "z"), (9, "y")]
    writers.write_folder(second, path, partitioned_by=["p"], dynamic=False)
    assert _rows(spark.read.parquet(path)) == [(8, "z"), (9, "y")]


def test_empty_tables_are_written_and_counted(spark, folder):
    schema = "a string, b string, c string"
    empties = [
        spark.createDataFrame([], schema),
        spark.createDataFrame(AWKWARD, THREE).where("a = 'no such value'"),
        spark.createDataFrame(AWKWARD, THREE).where("1 = 0"),
    ]
    for at, df in enumerate(empties):
        path = os.path.join(folder, str(at))
        assert writers.write_folder(df, path) == 0
        assert writers.write_folder(df, path, partitioned_by=["c"]) == 0
        assert writers.write_lossless_csv(df, path) == 0
        assert readers.read_lossless_csv(spark, path, THREE).count() == 0


def test_avro_contract_round_trip(spark, folder):
    text = contract.avro_contract(contract.RAW, "job_postings")
    assert len(json.loads(text)["fields"]) == 22
    path = _text(folder, text, "postings.avsc")
    assert contract.load_avro_contract(spark, path, THREE) == contract.RAW
    typed = {
        "type": "record",
        "name": "t",
        "fields": [{"name": "n", "type": "long"}, {"name": "x", "type": ["null", "double"]}],
    }
    assert contract.parse_avro_contract(json.dumps(typed)) == T.StructType(
        [T.StructField("n", T.LongType(), False), T.StructField("x", T.DoubleType())]
    )


@pytest.mark.parametrize("text", ["{", '{"type": "enum"}', None])
def test_unusable_contract_falls_back(spark, folder, text):
    path = _text(folder, text, "bad.avsc") if text else os.path.join(folder, "missing.avsc")
    with pytest.warns(UserWarning, match="falling back"):
        assert contract.load_avro_contract(spark, path, THREE) == THREE


def test_catalog_tables(spark, folder):
    database = "catalog_test"
    catalog.ensure_database(spark, database, os.path.join(folder, database), reset=True)
    df = spark.createDataFrame(AWKWARD, THREE)
    catalog.register_view(df, "awkward_rows")
    assert spark.table("awkward_rows").count() == len(AWKWARD)

    text_table = f"{database}.texts"
    catalog.create_text_table(spark, text_table, os.path.join(folder, "texts"), THREE)
    for _ in range(2):
        catalog.insert_overwrite(df.toDF("X", "Y", "Z"), text_table)
        assert _rows(spark.table(text_table)) == _rows(df)
    with pytest.raises(AnalysisException):
        catalog.insert_overwrite(df.select("a", "b"), text_table)

    parted = f"{database}.parted"
    where = os.path.join(folder, "parted")
    catalog.create_source_table(spark, parted, where, THREE, "parquet", partitioned_by=["b"])
    schema = "A string, B string, C string"
    first = spark.createDataFrame([("1", "p", "x"), ("2", "q", "x")], schema)
    catalog.insert_overwrite(first, parted, ["B"])
    second = spark.createDataFrame([("3", "q", "y"), ("4", "r", "y")], schema)
    for _ in range(2):
        assert catalog.insert_overwrite(second, parted, ["B"]) == 2
        expected = [("1", "x", "p"), ("3", "y", "q"), ("4", "y", "r")]
        assert _rows(spark.table(parted)) == expected
    partitions = [row[0] for row in catalog.list_partitions(spark, parted).collect()]
    assert partitions == ["b=p", "b=q", "b=r"]

    catalog.insert_overwrite(first, parted, ["B"], dynamic=False)
    assert _rows(spark.table(parted)) == [("1", "x", "p"), ("2", "x", "q")]

    names = {row.tableName for row in catalog.list_tables(spark, database).collect()}
    assert {"texts", "parted"} <= names
    assert catalog.storage_format(spark, parted) == "parquet"
    assert catalog.describe_value(spark, parted, "no such entry") is None
    assert catalog.storage_codec(spark, parted) == "snappy"
    assert catalog.require_storage(spark, parted, "parquet") == "parquet"
    with pytest.raises(ValueError, match="parquet with snappy, not avro"):
        catalog.require_avro(spark, parted)
    with pytest.raises(ValueError, match="not parquet with zstd"):
        catalog.require_storage(spark, parted, "parquet", "zstd")

    catalog.ensure_database(spark, database, os.path.join(folder, database), reset=True)
    assert catalog.list_tables(spark, database).where("NOT isTemporary").count() == 0
    spark.sql(f"DROP DATABASE {database}")


@pytest.mark.parametrize("url", [None, "hdfs:///schema/it's.avsc"])
def test_hive_avro_definition(spark, url):
    """Without Hive support Spark accepts the text and refuses only to run it."""
    ddl = catalog.hive_avro_ddl(
        "default.landing", "/tmp/landing", THREE, schema_url=url, partitioned_by=["b"]
    )
    assert "STORED AS AVRO" in ddl and "'avro.output.codec' = 'snappy'" in ddl
    assert "PARTITIONED BY (`b` string)" in ddl
    if url is None:
        assert '"name": "b"' not in ddl
    plan = "\n".join(row[0] for row in spark.sql(f"EXPLAIN {ddl}").collect())
    assert "NOT_SUPPORTED_COMMAND_WITHOUT_HIVE_SUPPORT" in plan
    assert "AvroSerDe" in plan


def test_inline_contract_is_valid_avro(spark):
    text = contract.avro_contract(contract.RAW, "job_postings")
    parsed = spark._jvm.org.apache.avro.Schema.Parser().parse(text)
    assert parsed.getFields().size() == 22


def test_work_folder_is_never_local_on_a_cluster():
    def session(master, setting=None, known=None):
        context = SimpleNamespace(
            master=master, getCheckpointDir=lambda: known, setCheckpointDir=lambda folder: None
        )
        conf = SimpleNamespace(get=lambda key, default: setting or default)
        return SimpleNamespace(sparkContext=context, conf=conf)

    assert workspace.work_folder(session("yarn", "hdfs:///work")) == "hdfs:///work"
    assert workspace.work_folder(session("yarn", known="hdfs:///set")) == "hdfs:///set"
    assert "run-" in workspace.work_folder(session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.work_folder(session("yarn"))
