"""Aggregate states per partition: merged results, what is read again, and stale states."""

import glob
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobstrata.operators import states
from jobstrata.operators.aggregates import impact_aggregate
from jobstrata.plans.standin import postings
from jobstrata.sources.writers import write_folder
from small_data import SMALL_DATA

KEYS = ["city"]


@pytest.fixture(scope="module")
def whole(spark):
    df = postings(spark, SMALL_DATA).cache()
    yield df
    df.unpersist()


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def land(spark, rows, folder, keys=KEYS):
    """Load ``rows`` into the landing folder and refresh the states."""
    table_path, states_path = os.path.join(folder, "landing"), os.path.join(folder, "states")
    write_folder(rows, table_path, "parquet", keys)
    table = spark.read.schema(rows.schema).parquet(table_path)
    changed = states.refresh_states(table, table_path, states_path, keys)
    return table, table_path, states_path, changed


def test_loads_partition_by_partition(spark, whole, folder):
    wrong = whole.where("city <> 'city_3' OR industry = 'building'")
    table, path, kept, changed = land(spark, wrong, folder)
    assert len(changed) == whole.select("city").distinct().count()
    merged = states.impact_from_states(table, path, kept, KEYS)
    assert rows_of(merged) == rows_of(impact_aggregate(wrong, known_rows=10**6))
    table, path, kept, changed = land(spark, whole.where("city = 'city_3'"), folder)
    assert changed == [("city_3",)]
    merged = states.impact_from_states(table, path, kept, KEYS)
    assert rows_of(merged) == rows_of(impact_aggregate(whole, known_rows=10**6))
    assert states.refresh_states(table, path, kept, KEYS) == []


def test_untouched_partitions_are_not_opened(spark, whole, folder):
    land(spark, whole, folder)
    # Files of other partitions can't be read any more, but look the same in a listing.
    spoiled = {}
    for name in glob.glob(f"{folder}/landing/city=*/*.parquet"):
        if "city=city_3" not in name:
            spoiled[name] = open(name, "rb").read(), os.stat(name)
    for name, (raw, stat) in spoiled.items():
        open(name, "wb").write(b"x" * len(raw))
        os.utime(name, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    for crc in glob.glob(f"{folder}/landing/city=*/.*.crc"):
        os.remove(crc)
    again = whole.where("city = 'city_3' AND industry <> 'x'")
    table, path, kept, changed = land(spark, again, folder)
    assert changed == [("city_3",)]
    with pytest.raises(Exception):
        table.agg(F.max("job_id")).collect()
    for name, (raw, stat) in spoiled.items():
        open(name, "wb").write(raw)
        os.utime(name, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    merged = states.impact_from_states(table, path, kept, KEYS)
    assert rows_of(merged) == rows_of(impact_aggregate(whole, known_rows=10**6))


def test_stale_states_are_refused_and_made_good(spark, whole, folder):
    table, path, kept, _ = land(spark, whole, folder)
    write_folder(whole.where("city = 'city_1'").limit(40), path, "parquet", KEYS)
    table = spark.read.schema(whole.schema).parquet(path)
    with pytest.raises(ValueError, match="1 partitions have no states"):
        states.impact_from_states(table, path, kept, KEYS)
    assert states.refresh_states(table, path, kept, KEYS) == [("city_1",)]
    merged = states.impact_from_states(table, path, kept, KEYS)
    assert rows_of(merged) == rows_of(impact_aggregate(table, known_rows=10**6))


def test_dropped_partitions_no_longer_count(spark, whole, folder):
    table, path, kept, _ = land(spark, whole, folder)
    rest = whole.where("city <> 'city_2'")
    write_folder(rest, path, "parquet", KEYS, dynamic=False)
    table = spark.read.schema(rest.schema).parquet(path)
    states.refresh_states(table, path, kept, KEYS)
    merged = states.impact_from_states(table, path, kept, KEYS)
    assert rows_of(merged) == rows_of(impact_aggregate(rest, known_rows=10**6))


def test_odd_partition_values_and_many_keys(spark, rows, folder):
    values = [None, "a b", "a+b", "50%", "x=y", "1", "01", "é", "a/b"]
    data = rows(
        *[{"city": c, "posting_year": y, "salary_usd": str(n), "ai_mentioned": "True"}
          for n, c in enumerate(values) for y in ("2020", "2020.0", None)]
    )
    keys = ["city", "posting_year"]
    table, path, kept, changed = land(spark, data, folder, keys)
    assert len(changed) == 27
    merged = states.impact_from_states(table, path, kept, keys)
    assert rows_of(merged) == rows_of(impact_aggregate(data, known_rows=100))
    table, path, kept, changed = land(spark, data.where("city = '50%'"), folder, keys)
    assert {c for c, _ in changed} == {"50%"} and len(changed) == 3


def test_many_partitions_are_joined(spark, whole, folder, monkeypatch):
    monkeypatch.setattr(states, "NAMED_PARTITIONS", 1)
    table, path, kept, _ = land(spark, whole, folder)
    write_folder(whole.where("city IN ('city_1', 'city_2')"), path, "parquet", KEYS)
    table = spark.read.schema(whole.schema).parquet(path)
    assert len(states.refresh_states(table, path, kept, KEYS)) == 2
    merged = states.impact_from_states(table, path, kept, KEYS)
    assert rows_of(merged) == rows_of(impact_aggregate(whole, known_rows=10**6))


def test_without_states_or_rows(spark, whole, folder):
    with pytest.raises(ValueError, match="no states"):
        table = whole.limit(5)
        write_folder(table, f"{folder}/t", "parquet", KEYS)
        states.impact_from_states(table, f"{folder}/t", f"{folder}/none", KEYS)
