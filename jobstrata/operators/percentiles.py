"""Exact per-group percentiles that never put a whole group into one task.

The built-in ``percentile`` keeps every distinct value of a group in one aggregation
buffer. A group may hold a third of all rows, so that buffer has no bound. Here the wanted
ranks are located in steps:

1. Histogram. Values fall into logarithmic cells (monotone in the value). One aggregate by
   group and cell counts them, with map-side combine; a group has at most some 135,000
   cells. A running count over the cells of a group says which cell holds which rank.
2. Points. Only rows of a cell that holds a wanted rank are read again, as distinct values
   with counts.
3. Split. While such a cell still has more than ``window_rows`` rows, it is divided into
   equal-width cells and step 1 is repeated on the points.
4. Pick. A running count over the at most ``window_rows`` values of a cell finds the rank.

A cell whose lowest and highest value are equal is answered from the histogram. The result
equals ``percentile`` (linear interpolation) on every group, nulls left out.

Before these steps one aggregate by group takes counts, sums, lowest and highest values, and
the groups are numbered. While they can be broadcast, rows are known by the number of their group
and a value from there on, so no step hashes, sorts or shuffles the keys themselves.

The built-in still does the work wherever its buffer is proven small: in a single pass when
the caller knows that the whole input has at most ``single_pass_rows`` rows, and in the
second pass when the counts show that no group has more than ``GROUP_ROWS``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from jobstrata.workspace import materialise

CELLS_PER_OCTAVE = 32
# Above CELLS_PER_OCTAVE * 1075, so that the cell of every positive double is positive.
CELL_OFFSET = 40_000
SPLIT_CELLS = 1 << 16
# Most input rows for which the built-in is used in a single pass.
SINGLE_PASS_ROWS = 1 << 20
# Most rows of any group for which the built-in is used on an input of any size. With Spark's
# default a task holds 128 groups before it sorts, at some 64 bytes a value: about 256 MB.
GROUP_ROWS = 1 << 15
# Most rows a single sorted window may see.
WINDOW_ROWS = 4_000_000
# Most bytes of located cells that are sent to every executor; more are joined by shuffle.
BROADCAST_BYTES = 64 << 20
# Size of one located cell in a broadcast set of 64-bit hashes.
HASH_BYTES = 32
# Rows of a cell that a salted join leaves together.
SALT_ROWS = 1 << 17


def _log_cell(value: Column) -> Column:
    """Signed logarithmic cell number as a double; keeps infinities and NaN in order."""
    octave = F.rint(F.log2(F.abs(value)) * CELLS_PER_OCTAVE) + CELL_OFFSET
    return F.when(value == 0, 0.0).otherwise(F.signum(value) * octave)


def _linear_cell(value: Column, low: Column, high: Column) -> Column:
    return F.floor((value - low) / (high - low) * SPLIT_CELLS).cast("double")


def _position(total: Column, fraction: float) -> Column:
    return (total - 1) * F.lit(float(fraction))


def _wanted_ranks(total: Column, fractions: Sequence[float]) -> Column:
    """Zero-based ranks on both sides of every position."""
    ranks = []
    for fraction in fractions:
        position = _position(total, fraction)
        ranks += [F.floor(position), F.ceil(position)]
    return F.array_distinct(F.array(*ranks))


def _keep_ranked(counted: DataFrame, within: Sequence[str], order: str) -> DataFrame:
    """Rows of ``counted`` that hold a wanted rank, with those ranks and the rows below.

    ``_n`` rows stand behind each row; ``_below`` counts the rows before the whole window.
    """
    running = (
        Window.partitionBy(*within)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    upto = F.col("_upto")
    below = upto - F.col("_n")
    return (
        counted.withColumn("_upto", F.col("_below") + F.sum("_n").over(running))
        .withColumn("_ranks", F.filter("_ranks", lambda rank: (rank >= below) & (rank < upto)))
        .where(F.size("_ranks") > 0)
        .withColumn("_below", below)
        .drop("_upto")
    )


def _join_on(left: DataFrame, right: DataFrame, names: Sequence[str], how="inner") -> DataFrame:
    """Null-safe join on ``names``, which the result holds once."""
    other = right.select(*[F.col(c).alias(f"_r{c}" if c in names else c) for c in right.columns])
    same = reduce(and_, [left[name].eqNullSafe(other[f"_r{name}"]) for name in names])
    return left.join(other, same, how).drop(*[f"_r{name}" for name in names])


def _merged(groups: DataFrame, more: DataFrame, keys: Sequence[str], *gathered: Column):
    """One row per group with the columns of ``groups`` and what ``gathered`` makes of the
    rows of ``more``: one aggregate, to which a null key is a key like any other."""
    both = groups.unionByName(more, allowMissingColumns=True)
    own = [F.max(name).alias(name) for name in groups.columns if name not in keys]
    return both.groupBy(*keys).agg(*own, *gathered)


def _size(cells: DataFrame, keys: Sequence[str]) -> Row:
    """Rows of the widest cell (null without cells), cells, and an upper estimate of their
    bytes: UTF-8 keys and fixed-width columns."""
    text = F.octet_length(F.concat_ws("", *[F.col(key).cast("string") for key in keys]))
    return cells.agg(
        F.max("_n").alias("widest"),
        F.count(F.lit(1)).alias("cells"),
        F.coalesce(F.sum(text + 64 * (len(keys) + 4)), F.lit(0)).alias("bytes"),
    ).first()


def _in_cells(
    rows: DataFrame, cells: DataFrame, at: Sequence[str], size: Row, broadcast_bytes: int
) -> DataFrame:
    """Rows whose ``at`` columns name one of ``cells``, with the columns of the cell."""
    cells = cells.drop("_n")
    if size["bytes"] <= broadcast_bytes:
        return _join_on(rows, F.broadcast(cells), at)
    salts = max(1, -(-size["widest"] // SALT_ROWS))
    salt = F.pmod(F.xxhash64("_value"), F.lit(salts))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    salted = _join_on(
        rows.withColumn("_salt", salt), cells.withColumn("_salt", copies), [*at, "_salt"]
    )
    return salted.drop("_salt")


def _points(
    rows: DataFrame, cells: DataFrame, keys: Sequence[str], size: Row, broadcast_bytes: int
) -> DataFrame:
    """Distinct values with counts inside ``cells``.

    Cells that are too large together to be broadcast as rows may still fit as hashes. Either
    drops most rows before the shuffle, which moves keys, cell and value alone; what is known of
    the cell is joined behind it.
    """
    at = [*keys, "_cell"]
    count = F.count(F.lit(1)).alias("_n")
    if size["bytes"] <= broadcast_bytes:
        rows = _join_on(rows, F.broadcast(cells.select(*at)), at, "left_semi")
    elif size["cells"] * HASH_BYTES <= broadcast_bytes:
        hashes = cells.select(F.xxhash64(*at).alias("_hash")).distinct()
        rows = rows.join(F.broadcast(hashes), F.xxhash64(*at) == F.col("_hash"), "left_semi")
    distinct = rows.groupBy(*at, "_value").agg(count)
    return _in_cells(distinct, cells, at, size, broadcast_bytes).drop("_cell")


def _split(points: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Divide every cell; returns the finer cells holding ranks and the points with cells."""
    cell = _linear_cell(F.col("_value"), F.col("_lo"), F.col("_hi"))
    points = points.withColumn("_cell", cell).withColumnRenamed("_lo", "_parent")
    finer = points.groupBy(*keys, "_parent", "_below", "_ranks", "_cell").agg(
        F.sum("_n").alias("_n"),
        F.min("_value").alias("_lo"),
        F.max("_value").alias("_hi"),
    )
    points = points.select(*keys, "_parent", "_cell", "_value", "_n")
    return _keep_ranked(finer, [*keys, "_parent"], "_cell"), points


def _interpolated(at: Column, total: Column, fraction: float) -> Column:
    position = _position(total, fraction)
    low_rank, high_rank = F.floor(position), F.ceil(position)
    low, high = at[low_rank], at[high_rank]
    between = (high_rank - position) * low + (position - low_rank) * high
    return F.when(low == high, low).otherwise(between)


def reads_once(known_rows: int | None, single_pass_rows: int = SINGLE_PASS_ROWS) -> bool:
    """Whether :func:`grouped_percentiles` reads its input once."""
    return known_rows is not None and known_rows <= single_pass_rows


def stored_rows(
    df: DataFrame, known_rows: int | None, single_pass_rows: int = SINGLE_PASS_ROWS
) -> DataFrame:
    """``df``, from the work folder where :func:`grouped_percentiles` reads it several times, so
    that it is computed once."""
    return df if reads_once(known_rows, single_pass_rows) else materialise(df, "rows")


def grouped_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    fractions: Mapping[str, float],
    sums: Mapping[str, Column] | None = None,
    *,
    known_rows: int | None = None,
    single_pass_rows: int = SINGLE_PASS_ROWS,
    window_rows: int = WINDOW_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per group: ``keys``, one exact percentile per entry of ``fractions``, the
    non-null count ``value_count``, ``value_min`` and ``value_max``, and every additive
    aggregate of ``sums``, which shares the scan and shuffle of the counts.

    ``known_rows`` is an upper bound of the input rows where the caller has one, such as a
    Parquet footer count or the count of the write before. Without one, or above
    ``single_pass_rows``, ``df`` is read up to three times, so it must give the same rows each
    time and should be cheap to read (see :func:`stored_rows`), and the groups and the histogram
    are materialised in the checkpoint folder. ``single_pass_rows=0`` takes the located way whatever
    the size.
    """
    keys = list(keys)
    df = df.withColumn("_value", value)
    value = F.col("_value")
    # One buffer of values per group, however many fractions.
    builtin = F.percentile(value, F.array(*map(F.lit, map(float, fractions.values()))))
    picked = [F.col("_all")[at].alias(name) for at, name in enumerate(fractions)]
    totals = {
        "value_count": F.count(value),
        "value_min": F.min(value),
        "value_max": F.max(value),
        **(sums or {}),
    }
    summed = [column.alias(name) for name, column in totals.items()]
    if reads_once(known_rows, single_pass_rows):
        single = df.groupBy(*keys).agg(builtin.alias("_all"), *summed)
        return single.select(*keys, *picked, *totals)
    groups = materialise(
        df.groupBy(*keys).agg(*summed).withColumn("_group", F.monotonically_increasing_id())
    )
    size = _size(groups.withColumn("_n", F.col("value_count")), keys)
    if size["bytes"] <= broadcast_bytes:
        at = ["_group"]
        df = _join_on(df, F.broadcast(groups.select(*keys, *at)), keys)
    else:
        at, groups = keys, groups.drop("_group")
    rows = df.select(*at, "_value")
    group_rows = min(single_pass_rows, GROUP_ROWS)
    if group_rows and (size["widest"] or 0) <= group_rows:
        found = rows.groupBy(*at).agg(builtin.alias("_all")).select(*at, *picked)
    else:
        found = located_percentiles(
            materialise(cell_counts(rows, at, value, {})),
            lambda cells: rows,
            at,
            value,
            fractions,
            window_rows=window_rows,
            broadcast_bytes=broadcast_bytes,
        ).select(*at, *fractions)
    shares = [F.max(name).alias(name) for name in fractions]
    return _merged(groups, found, at, *shares).select(*keys, *fractions, *totals)


def cell_counts(
    df: DataFrame, keys: Sequence[str], value: Column, sums: Mapping[str, Column]
) -> DataFrame:
    """The histogram: per group and logarithmic cell the rows with a value, the lowest and the
    highest one, and every additive aggregate of ``sums``. Histograms of parts of a table
    merge by :func:`merged_counts`."""
    valued = df.withColumn("_value", value)
    value = F.col("_value")
    return (
        valued.withColumn("_cell", _log_cell(value))
        .groupBy(*keys, "_cell")
        .agg(
            F.count(value).alias("_n"),
            F.min(value).alias("_lo"),
            F.max(value).alias("_hi"),
            *[column.alias(f"_sum_{name}") for name, column in sums.items()],
        )
    )


def merged_counts(counts: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Histograms of several parts as one; ``names`` are those of the additive aggregates."""
    return counts.groupBy(*keys, "_cell").agg(
        F.sum("_n").alias("_n"),
        F.min("_lo").alias("_lo"),
        F.max("_hi").alias("_hi"),
        *[F.sum(f"_sum_{name}").alias(f"_sum_{name}") for name in names],
    )


def _groups(histogram: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    return histogram.groupBy(*keys).agg(
        F.sum("_n").alias("value_count"),
        F.min("_lo").alias("value_min"),
        F.max("_hi").alias("value_max"),
        *[F.sum(f"_sum_{name}").alias(name) for name in names],
    )


def located_percentiles(
    histogram: DataFrame,
    rows_of: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    value: Column,
    fractions: Mapping[str, float],
    names: Sequence[str] = (),
    *,
    window_rows: int = WINDOW_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The result of :func:`grouped_percentiles` from a stored histogram.

    ``rows_of`` gives the input rows for a second read, or those of them that can lie in the
    cells that it is called with; ``value`` is as for :func:`cell_counts`.
    """
    keys = list(keys)
    wanted = list(fractions.values())
    groups = _groups(histogram, keys, names)
    finished = ["value_count", "value_min", "value_max", *names]
    total = F.sum("_n").over(Window.partitionBy(*keys))
    ranked = _keep_ranked(
        histogram.where("_n > 0")
        .select(*keys, "_cell", "_n", "_lo", "_hi")
        .withColumn("_ranks", _wanted_ranks(total, wanted))
        .withColumn("_below", F.lit(0).cast("long")),
        keys,
        "_cell",
    )
    ranked = materialise(ranked)
    open_cell = F.col("_lo") < F.col("_hi")
    answered = [ranked.where(~open_cell).select(*keys, "_ranks", F.col("_lo").alias("_value"))]
    size = _size(ranked.where(open_cell), keys)
    if size["widest"] is not None:
        rows = rows_of(ranked.where(open_cell)).withColumn("_value", value)
        rows = rows.withColumn("_cell", _log_cell(F.col("_value")))
        rows = rows.where("_value IS NOT NULL").select(*keys, "_cell", "_value")
        points = _points(rows, ranked.where(open_cell), keys, size, broadcast_bytes)
        while size["widest"] is not None and size["widest"] > window_rows:
            finer, points = _split(materialise(points), keys)
            finer = materialise(finer)
            answered.append(
                finer.where(~open_cell).select(*keys, "_ranks", F.col("_lo").alias("_value"))
            )
            finer = finer.where(open_cell)
            size = _size(finer, keys)
            at = [*keys, "_parent", "_cell"]
            points = _in_cells(points, finer, at, size, broadcast_bytes).drop("_parent", "_cell")
        if size["widest"] is not None:
            picked = _keep_ranked(points, [*keys, "_lo"], "_value")
            answered.append(picked.select(*keys, "_ranks", "_value"))

    # At most two ranks per fraction and group reach the map.
    ranks = reduce(DataFrame.unionByName, answered).select(
        *keys, F.explode("_ranks").alias("_rank"), "_value"
    )
    entry = F.when(F.col("_rank").isNotNull(), F.struct("_rank", "_value"))
    at, total = F.col("_at"), F.col("value_count")
    return _merged(
        groups, ranks, keys, F.map_from_entries(F.collect_list(entry)).alias("_at")
    ).select(
        *keys,
        *[_interpolated(at, total, share).alias(name) for name, share in fractions.items()],
        *finished,
    )
