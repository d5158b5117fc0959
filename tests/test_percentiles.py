import math
import random

import pytest
from pyspark.sql import functions as F

from jobstrata.operators.percentiles import grouped_percentiles

SHARES = {"lowest": 0.0, "q1": 0.25, "median": 0.5, "p90": 0.9, "highest": 1.0}
KEYS = ["a", "b"]


def _values():
    """Groups that strain the histogram: one holds over a third of all rows."""
    rng = random.Random(7)
    groups = {
        ("hot", "narrow"): [50_000 + rng.random() for _ in range(1500)],
        ("hot", "single"): [42.0] * 700 + [None] * 20,
        ("wide", "signs"): [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(400)],
        ("wide", "zero"): [0.0, -0.0, 5e-324, -5e-324, 1e-310, 0.0],
        ("special", "nan"): [float("nan"), 1.0, 2.0, float("inf"), float("-inf"), float("nan")],
        ("one", "row"): [3.5],
        ("two", "rows"): [1.0, 2.0],
        ("none", "valued"): [None, None],
        (None, "null key"): [rng.randint(1, 30) * 1.0 for _ in range(200)],
        (None, None): [rng.gauss(0, 1e4) for _ in range(300)],
        ("", None): [math.nextafter(1.0, 2.0), 1.0, math.nextafter(1.0, 0.0)],
    }
    data = [(a, b, v) for (a, b), values in groups.items() for v in values]
    rng.shuffle(data)
    return data


@pytest.fixture(scope="module")
def table(spark):
    df = spark.createDataFrame(_values(), "a string, b string, v double")
    return df.repartition(4)


@pytest.fixture(scope="module")
def expected(table):
    """The built-in, which holds every value of a group at once."""
    return _plain(
        table.groupBy(*KEYS).agg(
            *[F.percentile("v", share).alias(name) for name, share in SHARES.items()],
            F.count("v").alias("value_count"),
            F.min("v").alias("value_min"),
            F.max("v").alias("value_max"),
            F.count(F.lit(1)).alias("rows"),
        )
    )


def _plain(df):
    def cell(value):
        if isinstance(value, float):
            # repr tells NaN apart from null; both zeros are one value.
            return repr(value + 0.0)
        return value

    columns = [*KEYS, *SHARES, "value_count", "value_min", "value_max", "rows"]
    return sorted((tuple(cell(v) for v in row) for row in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize(
    "limits",
    [
        {"known_rows": 10_000},
        {},
        {"single_pass_rows": 0},
        {"single_pass_rows": 0, "broadcast_bytes": 0},
        {"single_pass_rows": 0, "broadcast_bytes": 1000},
        {"single_pass_rows": 0, "window_rows": 3},
        {"single_pass_rows": 0, "window_rows": 1, "broadcast_bytes": 0},
        {"single_pass_rows": 100, "known_rows": 10_000, "window_rows": 50},
    ],
    ids=[
        "single-pass",
        "small-groups",
        "refined",
        "shuffled",
        "hashed",
        "split",
        "split-all",
        "known-large",
    ],
)
def test_equals_the_builtin(table, expected, limits):
    got = grouped_percentiles(
        table, KEYS, F.col("v"), SHARES, {"rows": F.count(F.lit(1))}, **limits
    )
    assert _plain(got) == expected


def test_small_groups_too_many_to_be_broadcast(table, expected):
    rows = {"rows": F.count(F.lit(1))}
    got = grouped_percentiles(table, KEYS, F.col("v"), SHARES, rows, broadcast_bytes=0)
    assert _plain(got) == expected


@pytest.mark.parametrize("broadcast_bytes, key", [(1 << 20, "_group"), (0, "a")])
def test_values_are_gathered_by_the_number_of_their_group(table, broadcast_bytes, key):
    """The built-in does not sort the keys themselves while the groups can be broadcast."""
    got = grouped_percentiles(
        table, KEYS, F.col("v"), SHARES, broadcast_bytes=broadcast_bytes
    )
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    gathered = [line for line in plan.splitlines() if "percentile(" in line and "Aggregate" in line]
    assert len(gathered) == 1 and f"Aggregate [{key}#" in gathered[0]


def test_ranks_come_back_without_a_join(table):
    """Groups and picked ranks meet in one aggregate: no join above it, and so no second
    shuffle of null-safe keys."""
    got = grouped_percentiles(table, KEYS, F.col("v"), SHARES, single_pass_rows=0)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    top = plan.split("Aggregate")[0]
    assert "Union" in plan and "Join" not in top


def test_steps_are_removed(table, spark):
    import os

    from jobstrata.workspace import scratch, work_folder

    folder = work_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    with scratch(spark) as path:
        rows = grouped_percentiles(table, KEYS, F.col("v"), SHARES, single_pass_rows=0).count()
        assert rows == 11 and os.listdir(path.removeprefix("file://"))
    assert set(os.listdir(folder)) == before


def test_located_cells_are_few(table):
    """The histogram of a group is bounded by the exponent range, not by its rows."""
    from jobstrata.operators.percentiles import CELL_OFFSET, CELLS_PER_OCTAVE, _log_cell

    cells = table.select(_log_cell(F.col("v")).alias("cell")).where("NOT isnan(cell)")
    finite = cells.where(F.abs("cell") < float("inf")).agg(F.max(F.abs("cell"))).first()[0]
    assert finite <= CELL_OFFSET + 1024 * CELLS_PER_OCTAVE
    smallest = table.sparkSession.range(1).select(_log_cell(F.lit(5e-324))).first()[0]
    assert smallest > 0
