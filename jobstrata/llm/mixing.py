"""Mixing sources to target weights by pivotal dependent rounding.

Every document has a wanted number of copies, the rate of its source. The whole part is
taken outright. The fractions are rounded in pairs: mass, counted in words, moves at random
from one document to the other until one of the two is whole, and the other meets the next
document. Each expectation is kept, and so is the sum of words of every pair. Documents are
dealt to small buckets of their source; what stays fractional, one document per bucket, goes
through a tree of the same step until one per source is left, which is drawn at the root.

Defined cases: null texts have size 0 and take 0 words; a null source is a source like any
other, last in order; rows equal in doc_id, source and size get the same number of copies; an
empty table gives no rows. Draws depend on ids and sizes only, so reruns agree.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobstrata.llm.common import as_row, stored, word_count

# Most copies of a document, and so the most a source can grow.
MOST = 3
# Documents in a bucket on average, and buckets below a node of the tree.
BUCKET = 1024
EDGE = 1e-9


def source_targets(sized: DataFrame, most: int = MOST) -> DataFrame:
    """One row per source of ``sized`` (source, size): source_size, target and items.

    Sources in code point order, null last, weigh 1, 2, 3, repeating. Shares above ``most``
    times a source's size are cut, and the excess is shared among the others by weight: with
    sources in order of their limit per weight, those that reach it are a prefix.
    """
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("items")
    )
    # One row per source from here on.
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = ((F.row_number().over(in_order) - 1) % 3 + 1).alias("weight")
    limit = most * F.col("source_size")
    by_limit = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    words_left = F.sum("source_size").over(every) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    weight_left = F.sum("weight").over(every) - F.coalesce(
        F.sum("weight").over(before), F.lit(0)
    )
    level = (words_left / weight_left).alias("level")
    leveled = totals.select("*", weight).select("*", level)
    full = limit <= F.col("level") * F.col("weight")
    common = F.min(F.when(~full, F.struct(limit / F.col("weight"), "level"))).over(every)
    return leveled.select("*", full.alias("full"), common["level"].alias("common")).select(
        "source",
        "source_size",
        "items",
        F.when(F.col("full"), limit.cast("double"))
        .otherwise(F.col("common") * F.col("weight"))
        .alias("target"),
    )


def _round_group(table: pa.Table, seed: int) -> pa.Table:
    """Rounds all fractions of one group but the last; ``fraction`` is null where done.

    At the root of a source the last is drawn too. What the draw adds or takes, which counts
    where one document holds much of its source, is given back by turning documents of the
    same node, longest first, while that brings the words nearer to the target.
    """
    # Long documents first: among documents of like size either may become whole, so that
    # what is left in the end is a short one.
    table = table.append_column("mass", pc.multiply(table["size"], table["repeats"]))
    keys = [("mass", "descending"), ("draw", "ascending"), ("doc_id", "ascending")]
    table = table.take(pc.sort_indices(table, [*keys, ("size", "ascending")]))
    mass = table["mass"].to_numpy().astype(float)
    table = table.drop_columns("mass")
    part = table["fraction"].to_numpy().copy()
    up = np.zeros(len(part), np.int64)
    chance = np.random.default_rng([seed, len(part)]).random(len(part) + 1)
    left = -1
    for here in range(len(part)):
        if left < 0:
            left = here
            continue
        ratio = mass[left] / mass[here]
        more = min(1 - part[left], part[here] / ratio)
        less = min(part[left], (1 - part[here]) / ratio)
        move = more if chance[here] * (more + less) < less else -less
        part[left] += move
        part[here] -= move * ratio
        open_ones = [i for i in (left, here) if EDGE < part[i] < 1 - EDGE]
        for i in {left, here} - set(open_ones):
            up[i] = part[i] > 0.5
            part[i] = np.nan
        left = open_ones[0] if open_ones else -1
    if left >= 0 and table["buckets"][0].as_py() == 1:
        up[left] = chance[-1] < part[left]
        over = (up[left] - part[left]) * mass[left]
        part[left] = np.nan
        for i in range(len(part)):
            if i != left and mass[i] <= abs(over) and up[i] == (over > 0):
                up[i] = 1 - up[i]
                over += (2 * up[i] - 1) * mass[i]
    for name, values in (
        ("fraction", pa.array(part, from_pandas=True)),
        ("copies", pc.add(table["copies"], pa.array(up))),
    ):
        table = table.set_column(table.schema.names.index(name), name, values)
    return table


def _round(key: tuple, table: pa.Table) -> pa.Table:
    return _round_group(table, zlib.crc32(repr([k.as_py() for k in key]).encode()))


def copies(docs: DataFrame, seed: int = 1, most: int = MOST) -> DataFrame:
    """One row per distinct (doc_id, source, size): repeats in the input, source_size, target
    and copies of each of its rows that the mix takes."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    items = stored(
        sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("repeats")), "mix"
    )
    weighed = items.select("source", (F.col("size") * F.col("repeats")).alias("size"))
    targets = stored(source_targets(weighed, most), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate + EDGE)
    fraction = F.when((rate - whole > EDGE) & (F.col("size") > 0), rate - whole)
    buckets = F.ceil(F.col("items") / BUCKET)
    draw = F.xxhash64(F.lit(seed), "doc_id", "size")
    joined = items.join(
        targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    )
    state = joined.select(
        "doc_id",
        "source",
        "size",
        "repeats",
        "source_size",
        "target",
        whole.cast("long").alias("copies"),
        fraction.cast("double").alias("fraction"),
        draw.alias("draw"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), buckets).alias("node"),
        buckets.alias("buckets"),
    )
    rounded = state.where("fraction IS NULL")
    state = state.where("fraction IS NOT NULL")
    most_nodes = targets.agg(F.max(buckets)).first()[0] or 0
    while most_nodes:
        state = stored(state.groupBy("source", "node").applyInArrow(_round, state.schema), "mix")
        rounded = rounded.unionByName(state.where("fraction IS NULL"))
        state = state.where("fraction IS NOT NULL").withColumns(
            {
                "node": F.floor(F.col("node") / BUCKET),
                "buckets": F.ceil(F.col("buckets") / BUCKET),
            }
        )
        most_nodes = 0 if most_nodes == 1 else -(-most_nodes // BUCKET)
    return rounded.drop("fraction", "draw", "node", "buckets")


def mix(docs: DataFrame, seed: int = 1, most: int = MOST) -> DataFrame:
    """``docs`` as the mix takes it: each row as often as its copies say."""
    taken = copies(docs, seed, most).where("copies > 0")
    rows = docs.select(as_row(docs), word_count(F.col("text")).alias("words"))
    matched = rows.join(
        taken,
        F.col("row.doc_id").eqNullSafe(F.col("doc_id"))
        & F.col("row.source").eqNullSafe(F.col("source"))
        & (F.col("words") == F.col("size")),
    )
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return matched.select("row", each).select("row.*")
