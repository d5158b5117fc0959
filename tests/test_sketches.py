"""Sketched quantiles against exact ranks, alone and merged."""

import pytest
from pyspark.sql import functions as F

from jobstrata.operators import sketches


@pytest.fixture(scope="module")
def rows(spark):
    ids = spark.range(200_000)
    return ids.select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
        (F.col("id") % 11).alias("part"),
        F.pow(F.rand(5), 4).alias("v"),
    )


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_ranks_are_within_the_error(rows, fraction):
    value = F.col("v")
    parts = sketches.value_sketches(rows, ["part", "k"], value)
    whole = sketches.merged_sketches(parts, ["k"])
    for made in (whole, sketches.value_sketches(rows, ["k"], value)):
        found = sketches.quantiles(made, ["k"], {"q": fraction})
        told = sketches.within_error(rows, found, ["k"], value, "q", fraction).collect()
        assert len(told) == 8 and all(r.within for r in told)
        assert sum(r.n for r in told) == 200_000
    assert whole.select(F.max(F.length("sketch"))).first()[0] < 64_000


def test_a_wrong_quantile_is_told(rows):
    value = F.col("v")
    found = sketches.quantiles(sketches.value_sketches(rows, ["k"], value), ["k"], {"q": 0.55})
    told = sketches.within_error(rows, found, ["k"], value, "q", 0.5).collect()
    assert not any(r.within for r in told)


def test_nulls_and_nan(spark):
    df = spark.createDataFrame(
        [(None, 1.0), (None, float("nan")), ("a", None), ("b", 2.0), ("b", 2.0)], "k string, v double"
    )
    made = sketches.merged_sketches(sketches.value_sketches(df, ["k"], F.col("v")), ["k"])
    got = {r.k: (r.n, r.q) for r in sketches.quantiles(made, ["k"], {"q": 0.5}).collect()}
    assert got == {None: (1, 1.0), "a": (0, None), "b": (2, 2.0)}
    told = sketches.within_error(
        df.where("NOT isnan(v) OR v IS NULL"),
        sketches.quantiles(made, ["k"], {"q": 0.5}),
        ["k"],
        F.col("v"),
        "q",
        0.5,
    )
    assert all(r.within for r in told.collect())
