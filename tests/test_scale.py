"""What queries shuffle, store and read by one task, told from plans and files."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from small_data import SMALL_DATA
from jobstrata.contract import RAW
from jobstrata.operators import aggregates, projections, quality
from jobstrata.plans import catalog_queries, registry, standin
from jobstrata.sources import aligned_text, readers, writers


def in_parts(module, monkeypatch, parts=3):
    """Stand-in postings in several tasks, as large ones come."""
    whole = standin.postings
    monkeypatch.setattr(module, "postings", lambda *args: whole(*args).repartition(parts))


def spied(module, name, monkeypatch):
    calls, real = [], getattr(module, name)

    def run(*args, **kwargs):
        calls.append(args)
        return real(*args, **kwargs)

    monkeypatch.setattr(module, name, run)
    return calls


def test_line_items_are_joined_after_orders_and_before_small_tables(spark):
    plan = standin.postings(spark, SMALL_DATA)._jdf.queryExecution().optimizedPlan().toString()
    joins = re.findall(r"Join Inner, \((\w+)#", plan)
    keys = {"o_custkey": "c_custkey", "l_orderkey": "o_orderkey", "l_suppkey": "s_suppkey"}
    at = {name: next(i for i, j in enumerate(joins) if j in (name, other)) for name, other in keys.items()}
    # The root comes first.
    assert at["l_suppkey"] < at["l_orderkey"] < at["o_custkey"]


def test_broken_lines_are_written_by_every_task(spark, monkeypatch):
    in_parts(registry, monkeypatch)
    calls = spied(registry, "scan_in_splits", monkeypatch)
    registry.QUERIES["multiline_split_scan"](spark, SMALL_DATA)
    assert len(glob.glob(f"{calls[0][1]}/part-*")) == 3


def test_a_copy_in_another_order_is_written_by_every_task(spark, monkeypatch):
    in_parts(registry, monkeypatch)
    calls = spied(writers, "write_lossless_csv", monkeypatch)
    found = registry.QUERIES["content_reconcile"](spark, SMALL_DATA).collect()
    assert len(glob.glob(f"{calls[0][1]}/part-*")) == 3
    assert {r["sink"]: r["contents_match"] for r in found} == {
        "copied": True, "exchanged": False, "changed": False, "moved": False
    }


def test_headers_of_all_parts_of_a_text_are_checked(spark, monkeypatch):
    in_parts(catalog_queries, monkeypatch)
    calls = spied(quality, "header_check", monkeypatch)
    row = registry.QUERIES["header_check"](spark, SMALL_DATA).first()
    assert (row["files"], row["refused"]) == (5, 1)
    assert len(glob.glob(f"{calls[0][1]}/*/part-*")) > 5


def test_headers_and_rows_share_one_order_and_one_parse(spark, folder, monkeypatch):
    for name, text in (("1.csv", "b,a\n2,1\n"), ("2.csv", "a,c,b\n1,x,2\n")):
        with open(os.path.join(folder, name), "w") as out:
            out.write(text)
    calls = spied(aligned_text, "marked_lines", monkeypatch)
    both = spark.createDataFrame([], "a string, b string").schema
    got = aligned_text.aligned_scan(spark, folder, both)
    assert len(calls) == 1
    assert [tuple(r) for r in got.collect()] == [("1", "2", None)] * 2
    # One parse per width of a header.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 2


def test_the_raw_layer_is_compressed_and_reads_back(spark, folder):
    rows = spark.createDataFrame([("a\n,", ' "', "", None)], "a string, b string, c string, d string")
    path = f"{folder}/text"
    writers.write_lossless_csv(rows, path)
    assert glob.glob(f"{path}/part-*.snappy")
    assert readers.read_lossless_csv(spark, path, rows.schema).collect() == rows.collect()
    writers.export_csv(rows, f"{folder}/export", compression="snappy")
    assert readers.read_csv_export(spark, f"{folder}/export", rows.schema).collect() == rows.collect()
    assert glob.glob(f"{folder}/export/part-*.snappy")


def test_few_partition_values_are_not_shuffled(spark, folder):
    rows = spark.range(100, numPartitions=3).select("id", (F.col("id") % 2).alias("k"))
    assert writers.write_folder(rows, folder, partitioned_by=["k"], few_values=True) == 100
    assert len(glob.glob(f"{folder}/k=*/part-*")) == 6
    assert sorted(r["id"] for r in spark.read.parquet(folder).collect()) == list(range(100))


@pytest.mark.parametrize("name", ["managed_table", "reset_after_failure"])
def test_postings_of_two_writes_are_joined_once(spark, monkeypatch, name):
    calls = spied(catalog_queries, "postings", monkeypatch)
    stored = spied(catalog_queries, "materialise", monkeypatch)
    registry.QUERIES[name](spark, SMALL_DATA)
    assert len(calls) == 1 and stored[0][0].columns == RAW.names


@pytest.mark.parametrize("way", [{"known_rows": 1 << 30}, {}, {"single_pass_rows": 0}])
def test_an_aggregate_reads_its_input_once(spark, way):
    """Means, counts and medians come from stored keys and numbers, whichever way they go."""
    rows = standin.postings(spark, SMALL_DATA)
    for got in (aggregates.impact_aggregate(rows, **way), aggregates.group_median(
        projections.with_risk_tier(rows), **way
    )):
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "_group" in plan and "l_orderkey" not in plan


def test_a_single_file_of_a_large_table_joins_postings_once(spark, monkeypatch):
    small = registry.QUERIES["csv_export_single"](spark, SMALL_DATA).collect()
    monkeypatch.setattr(registry, "posting_bound", lambda *args: 1 << 30)
    calls = spied(writers, "export_csv", monkeypatch)
    large = registry.QUERIES["csv_export_single"](spark, SMALL_DATA).collect()
    assert sorted(map(repr, large)) == sorted(map(repr, small))
    plan = calls[0][0]._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan


def test_a_sample_is_looked_up_by_its_few_ids(spark, monkeypatch):
    stored = spied(registry, "materialise", monkeypatch)
    row = registry.QUERIES["sample_rows"](spark, SMALL_DATA).first()
    assert (row["sampled_rows"], row["foreign_rows"]) == (10, 0)
    assert stored[0][0].columns == RAW.names
