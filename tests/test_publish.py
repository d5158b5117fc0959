"""Rebuilds that fail, end, or are cut off between the steps of publishing."""

import os
import uuid

import pytest

from jobstrata.sources import catalog, publish, writers


@pytest.fixture
def database(spark, folder):
    name = f"publish_{uuid.uuid4().hex[:8]}"
    catalog.ensure_database(spark, name, os.path.join(folder, name))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def build(df, keys=()):
    def run(name, folder):
        writer = df.write.format("parquet").option("path", folder)
        (writer.partitionBy(*keys) if keys else writer).saveAsTable(name)
        return df.count()

    return run


def rows(spark, *values):
    return spark.createDataFrame([(v, v % 2) for v in values], "a int, k int")


def held(spark, table):
    return sorted(r.a for r in spark.table(table).collect())


def tables(spark, database):
    return {r.tableName for r in catalog.list_tables(spark, database).collect() if not r.isTemporary}


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_rebuilt_and_failed(spark, folder, database, keys):
    table, path = f"{database}.t", os.path.join(folder, "t")
    assert publish.rebuild(spark, table, path, build(rows(spark, 1, 2), keys)) == 2
    first = publish.location_of(spark, table)
    publish.rebuild(spark, table, path, build(rows(spark, 3, 4, 5), keys))
    assert held(spark, table) == [3, 4, 5]
    assert publish.location_of(spark, table) != first
    left = [d for d in os.listdir(folder) if d.startswith("t-")]
    assert len(left) == 1 and tables(spark, database) == {"t"}

    def failing(name, where):
        build(rows(spark, 6), keys)(name, where)
        raise RuntimeError("half-way")

    with pytest.raises(RuntimeError, match="half-way"):
        publish.rebuild(spark, table, path, failing)
    assert held(spark, table) == [3, 4, 5] and tables(spark, database) == {"t"}
    assert [d for d in os.listdir(folder) if d.startswith("t-")] == left


def test_other_columns_and_managed_tables(spark, folder, database):
    table, path = f"{database}.t", os.path.join(folder, "t")
    writers.save_parquet_table(rows(spark, 1), table)
    publish.rebuild(spark, table, path, build(rows(spark, 2)))
    assert held(spark, table) == [2]
    publish.rebuild(spark, table, path, build(rows(spark, 3).withColumnRenamed("k", "other")))
    assert spark.table(table).columns == ["a", "other"] and held(spark, table) == [3]
    assert not os.path.exists(os.path.join(folder, database, "t"))


def test_cut_off_between_the_renames(spark, folder, database):
    table, path = f"{database}.t", os.path.join(folder, "t")
    publish.rebuild(spark, table, path, build(rows(spark, 1)))
    build(rows(spark, 2))(table + publish.BUILT, os.path.join(folder, "t-half"))
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}{publish.REPLACED}")
    publish.recover(spark, table)
    assert held(spark, table) == [1] and tables(spark, database) == {"t"}
    assert not os.path.exists(os.path.join(folder, "t-half"))
    # Cut off after them: the old table is still there.
    build(rows(spark, 7))(table + publish.REPLACED, os.path.join(folder, "t-old"))
    publish.recover(spark, table)
    assert held(spark, table) == [1] and tables(spark, database) == {"t"}
    publish.recover(spark, table)


def test_other_tables_of_a_layer_go(spark, folder, database):
    writers.save_parquet_table(rows(spark, 1), f"{database}.kept")
    writers.save_parquet_table(rows(spark, 1), f"{database}.gone")
    assert publish.drop_others(spark, database, ["Kept"]) == ["gone"]
    assert tables(spark, database) == {"kept"}


def test_a_failed_run_leaves_the_layers(spark, folder):
    from jobstrata import config
    from jobstrata.config import LakeConfig
    from jobstrata.contract import RAW_COLUMNS
    from jobstrata.plans.pipeline import load, run_pipeline

    def source(*records):
        lines = [RAW_COLUMNS, *[[f"{r}{c}" for c in range(22)] for r in records]]
        with open(os.path.join(folder, "job_postings.csv"), "w") as out:
            out.write("".join(",".join(line) + "\n" for line in lines))

    source("a", "b")
    cfg = LakeConfig(
        folder, env="gap", base_path=folder, landing_format="parquet", reset=True,
        most_malformed_rows=0,
    )
    table = cfg.tables[0]
    run_pipeline(spark, cfg)
    source("c", "d", "e")
    broken = LakeConfig(**{**cfg.__dict__, "landing_format": "no_such_format"})
    with pytest.raises(Exception):
        run_pipeline(spark, broken)
    assert load(spark, cfg, config.WORKLOAD, table).count() == 3
    for layer, n in ((config.LANDING, 2), (config.CURATED, 2), (config.FUNCTIONAL, 2)):
        assert load(spark, cfg, layer, table).count() == n
    run_pipeline(spark, cfg)
    assert load(spark, cfg, config.LANDING, table).count() == 3
    for layer in (config.WORKLOAD, config.LANDING, config.CURATED, config.FUNCTIONAL):
        spark.sql(f"DROP DATABASE {cfg.database(layer)} CASCADE")
