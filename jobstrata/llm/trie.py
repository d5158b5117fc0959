"""Prefix trie of conversations, found by blocks of turns.

Each turn has a hash of its place, role and text, and a run of turns the exclusive or of theirs,
in 128 bits. Conversations are cut into blocks of ``BLOCK`` turns, one row each. Conversations
whose turns agree up to the end of a block share its digest, so grouping block rows by digest
gives, level by level, who goes which way. Where a block has no sibling, all that enter
it stay together to its end, and its inner nodes have the block's members. Only blocks with
siblings are opened: the digests of their inner turns are grouped, over different blocks, not over
conversations, and show where siblings part.

Sums over subtrees need no walk down the trie. A node belongs to its smallest member; what lies
below a node belongs to its members, except what its own smallest member owns above it. So a
value of nodes is added up per owner, then over the members of each node by the same grouping,
and the part above is a running sum along each owner's chain. Depth costs no rounds.

Nothing is kept together by conversation or node: running values along a conversation are taken
inside stretches of 1,024 places and carried over by a table of stretches; groups are combined
before each shuffle; children of one node are joined to it with very common parents broadcast.
Members that end at a node are joined as text in ranges of ids first; only the hash over these
texts runs in one task per node, which reads them one by one.

Defined cases: turns are ordered by turn, null first, then role and text; rows without a conv_id
are left out; a null role or text is empty; repeated rows are turns like any other; other columns
are ignored; a table without conversations gives no rows. Rows that share conv_id and turn by the
million are ordered in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobstrata.llm.common import join_counted, map_arrow, stored

# Turns of a block.
BLOCK = 4
# Places, or turn numbers, that one task keeps together; ids that are one text before hashing.
STRETCH = 1024
IDS = 4096
_NOTHING = hashlib.sha256().hexdigest()


# Of each kind of running value: taken over rows, taken over stretches, and put together.
_KINDS = {
    "count": (lambda c: F.count(F.lit(1)), F.sum, lambda a, b: a + b),
    "sum": (F.sum, F.sum, lambda a, b: a + b),
    "xor": (F.bit_xor, F.bit_xor, lambda a, b: a.bitwiseXOR(b)),
}


def running(
    df: DataFrame,
    key: str,
    order: str,
    values: dict[str, tuple[str, str]],
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """``df``, which is stored, with aggregates over the rows of its key before each row.

    ``values`` give a kind and a column for each name. Rows are kept together by stretches of
    ``order``; what stretches before one hold comes from a table of one row per stretch.
    """
    stretch = F.coalesce(F.floor(F.col(order) / STRETCH), F.lit(-(1 << 62))).alias("_stretch")
    rows = df.select("*", stretch)
    taken = {name: _KINDS[kind][0](column) for name, (kind, column) in values.items()}
    whole = rows.groupBy(key, "_stretch").agg(*[v.alias(name) for name, v in taken.items()])
    earlier = Window.partitionBy(key).orderBy("_stretch").rowsBetween(
        Window.unboundedPreceding, -1
    )
    again = {name: _KINDS[kind][1](name).over(earlier) for name, (kind, _) in values.items()}
    before = whole.select(
        F.col(key).alias("_key"),
        F.col("_stretch").alias("_at"),
        *[F.coalesce(v, F.lit(0)).alias(f"_{c}") for c, v in again.items()],
    )
    joined = rows.join(
        before.hint("merge"), (F.col(key) == F.col("_key")) & (F.col("_stretch") == F.col("_at"))
    )
    within = (
        Window.partitionBy("_key", "_at")
        .orderBy(F.col(order).asc_nulls_first(), *ties)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    added = [
        _KINDS[kind][2](
            F.col(f"_{name}"), F.coalesce(taken[name].over(within), F.lit(0))
        ).alias(name)
        for name, (kind, _) in values.items()
    ]
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *added)


def rebuilt(conversations: DataFrame, share: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin alike: all ids, and turns as conv_id, place, h1, h2, size.

    Conversation c begins with the first ``crc32(c) % most`` turns of ``c - c % share`` and goes
    on with its own turns after as many.
    """
    text = [F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")]
    turns = stored(
        conversations.where("conv_id IS NOT NULL").select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            text[0].alias("role"),
            text[1].alias("text"),
        ),
        "turns",
    )
    placed = running(turns, "conv_id", "turn", {"earlier": ("count", "turn")}, ("role", "text"))
    hashed = stored(
        placed.select(
            "conv_id",
            (F.col("earlier") + 1).alias("place"),
            F.xxhash64("role", "text").alias("h1"),
            F.xxhash64(F.lit(1), F.col("text"), F.col("role")).alias("h2"),
            F.octet_length("text").cast("long").alias("size"),
        ),
        "placed",
    )
    head = F.crc32(F.col("conv_id").cast("string")) % most
    lender = F.col("conv_id") - F.col("conv_id") % share
    every = hashed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    lent = hashed.where((F.col("place") < most) & (lender == F.col("conv_id"))).select(
        F.col("conv_id").alias("lender"), *[c for c in hashed.columns if c != "conv_id"]
    )
    ids = every.select("conv_id")
    borrowers = ids.select("conv_id", lender.alias("lender"), head.alias("head"))
    heads = borrowers.join(lent, "lender").where("place <= head").select(*hashed.columns)
    # Own turns move up where the lender has fewer turns than are asked for.
    least = every.select(
        F.col("conv_id").alias("lender"), F.least("turns", F.lit(most)).alias("has")
    )
    shorter = (
        borrowers.join(least, "lender", "left")
        .select("conv_id", (F.col("head") - F.coalesce("has", F.lit(0))).alias("gap"))
        .where("gap > 0")
    )
    moved = _by_stretch(hashed.where(F.col("place") > head), shorter, ["gap"])
    own = moved.withColumn("place", F.col("place") - F.coalesce("gap", F.lit(0)))
    return ids, heads.unionByName(own.drop("gap"))


def _by_stretch(rows: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` by conv_id and place with ``columns`` of ``table``, one row per conv_id, or null;
    rows of one conversation are joined by stretches."""
    at = F.floor(F.col("place") / STRETCH)
    stretches = rows.select("conv_id", at.alias("_at")).distinct()
    spread = stretches.join(table, "conv_id").select(
        F.col("conv_id").alias("_id"), "_at", *columns
    )
    found = rows.join(
        spread.hint("merge"), (F.col("conv_id") == F.col("_id")) & (at == F.col("_at")), "left"
    )
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], *columns)


def block_rows(turns: DataFrame) -> DataFrame:
    """One row per conversation and block: the digests before and through it, and its turns."""
    mixed = turns.select(
        "conv_id",
        F.floor((F.col("place") - 1) / BLOCK).alias("block"),
        F.struct(
            "place",
            F.xxhash64("place", "h1", "h2").alias("x1"),
            F.xxhash64(F.lit(1), F.col("h2"), F.col("h1"), F.col("place")).alias("x2"),
            "size",
        ).alias("turn"),
    )
    blocks = stored(
        mixed.groupBy("conv_id", "block").agg(
            F.bit_xor("turn.x1").alias("d1"),
            F.bit_xor("turn.x2").alias("d2"),
            F.sort_array(F.collect_list("turn")).alias("turns"),
        ),
        "blocks",
    )
    before = {"b1": ("xor", "d1"), "b2": ("xor", "d2")}
    found = running(blocks, "conv_id", "block", before)
    through = F.struct(
        F.col("b1").bitwiseXOR(F.col("d1")).alias("d1"),
        F.col("b2").bitwiseXOR(F.col("d2")).alias("d2"),
    )
    return stored(
        found.select(
            "conv_id",
            F.col("block").alias("place"),
            F.struct(F.col("b1").alias("d1"), F.col("b2").alias("d2")).alias("before"),
            through.alias("digest"),
            "turns",
        ),
        "block-rows",
    )


def block_groups(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Different blocks with their smallest member and number of members: those without a
    sibling, and those with."""
    groups = stored(
        blocks.groupBy("digest").agg(
            F.first("before").alias("before"),
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.first("turns").alias("turns"),
        ),
        "groups",
    )
    row = F.struct(*groups.columns).alias("row")
    alone = groups.groupBy("before").agg(F.first(row).alias("row"), F.count(F.lit(1)).alias("n"))
    alone = stored(alone.where("n = 1").select("row.*"), "alone")
    return alone, groups.join(alone.select("digest"), "digest", "left_anti")


def _opened(groups: DataFrame, values: list[str]) -> DataFrame:
    """A row per turn of each block: the node it leads to, the node before, depth and size."""
    places = F.sequence(F.lit(1), F.size("turns"))

    def through(part: str, n: Column) -> Column:
        return F.aggregate(
            F.slice("turns", F.lit(1), n),
            F.col(f"before.{part}"),
            lambda total, turn: total.bitwiseXOR(turn[f"x{part[1]}"]),
        )

    def node(n: Column) -> Column:
        return F.struct(through("d1", n).alias("d1"), through("d2", n).alias("d2"))

    steps = F.transform(
        places,
        lambda n: F.struct(
            node(n).alias("node"),
            node(n - 1).alias("parent"),
            F.get("turns", n - 1)["place"].alias("depth"),
            F.get("turns", n - 1)["size"].alias("size"),
        ),
    )
    return groups.select(F.explode(steps).alias("step"), *values).select("step.*", *values)


def _nodes(alone: DataFrame, others: DataFrame, sums: list[str], smallest: list[str]) -> DataFrame:
    """Nodes of all blocks; only those of blocks with siblings are grouped."""
    same = ["depth", "parent", "size"]
    values = [*sums, *smallest]
    parted = (
        _opened(others, values)
        .groupBy("node")
        .agg(
            *[F.first(c).alias(c) for c in same],
            *[F.sum(c).alias(c) for c in sums],
            *[F.min(c).alias(c) for c in smallest],
        )
    )
    columns = ["node", *same, *values]
    return _opened(alone, values).select(*columns).unionByName(parted.select(*columns))


def ends(ids: DataFrame, blocks: DataFrame) -> DataFrame:
    """node, ends_sha256 of every node where conversations end."""
    last = blocks.groupBy("conv_id").agg(F.max_by("digest", "place").alias("node"))
    root = F.struct(F.lit(0).cast("long").alias("d1"), F.lit(0).cast("long").alias("d2"))
    each = ids.join(last, "conv_id", "left").withColumn("node", F.coalesce("node", root))
    texts = each.groupBy("node", F.floor(F.col("conv_id") / IDS).alias("range")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    flat = texts.select("node.d1", "node.d2", "range", "ids")
    ordered = flat.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "range")
    hashed = map_arrow(ordered, _hash_ids, "d1 long, d2 long, ends_sha256 string")
    return hashed.select(F.struct("d1", "d2").alias("node"), "ends_sha256")


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per run of equal nodes; runs may go on through many batches."""
    names = ["d1", "d2", "ends_sha256"]
    key = digest = None
    for batch in batches:
        done = []
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("d1", "d2", "ids"))):
            if (a, b) == key:
                digest.update(b",")
            else:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = (a, b), hashlib.sha256()
            digest.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
    if key is not None:
        row = (*key, digest.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in row], names=names)


def prefix_trie(ids: DataFrame, turns: DataFrame) -> DataFrame:
    """All nodes of the trie of conversations ``ids`` with ``turns``, as ``rebuilt`` gives them."""
    ids = stored(ids, "ids")
    blocks = block_rows(turns)
    alone, others = block_groups(blocks)
    nodes = _nodes(alone, others, ["n_convs"], ["conv_id"])
    zero = F.lit(0).cast("long")
    root = F.struct(zero.alias("d1"), zero.alias("d2"))
    top = (
        ids.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
        .where("n_convs > 0")
        .select(
            root.alias("node"),
            zero.alias("depth"),
            F.lit(None).cast("struct<d1:bigint,d2:bigint>").alias("parent"),
            zero.alias("size"),
            "n_convs",
            "conv_id",
        )
    )
    every = stored(top.unionByName(nodes), "nodes")
    counted = every.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node"))
    children = counted.agg(F.count(F.lit(1)).alias("n_children"))
    weighed = every.join(children, "node", "left").select(
        *every.columns,
        F.coalesce("n_children", zero).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("weight"),
    )
    weighed = stored(weighed, "weighed")

    # Values of nodes by owner, and over the members of every node.
    owned = weighed.groupBy("conv_id").agg(
        F.sum("weight").alias("saved"),
        F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"),
    )
    owned = stored(owned, "owned")
    by_block = (
        _by_stretch(blocks.drop("turns", "before"), owned, ["saved", "leaves"])
        .groupBy("digest")
        .agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("saved", "leaves")])
    )
    by_block = stored(by_block, "sums")
    below = _nodes(
        alone.join(by_block, "digest"), others.join(by_block, "digest"), ["saved", "leaves"], []
    ).select("node", "saved", "leaves")
    total = owned.agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    below = total.where("leaves IS NOT NULL").select(root.alias("node"), "saved", "leaves").unionByName(below)

    above = running(weighed, "conv_id", "depth", {"above": ("sum", "weight")})
    summed = (
        above.join(below, "node")
        .join(ends(ids, blocks), "node", "left")
        .select(
            "parent",
            "conv_id",
            "depth",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            (F.col("saved") - F.col("above")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"),
        )
    )
    parents = weighed.where("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    parents = stored(parents.withColumnRenamed("n_children", "times"), "parents")
    return join_counted(summed, parents, "parent", "times").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )
