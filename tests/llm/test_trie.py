"""The conversation trie against a plain one, and its parts that split hot keys."""

import random
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from jobstrata.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def nodes(spark, rows):
    return trie.prefix_trie(*trie.rebuilt(spark.createDataFrame(rows, SCHEMA))).collect()


def check(spark, rows):
    got = Counter(map(tuple, nodes(spark, rows)))
    assert got == Counter(brute.conversation_nodes(rows))


@pytest.fixture
def drawn():
    draw = random.Random(8)
    rows = []
    for c in range(-12, 60):
        for turn in range(draw.randrange(0, 14)):
            text = draw.choice(["a", "b", "é", "", None]) if turn > 2 else "same"
            rows.append((c, turn, draw.choice(["user", None]) if turn > 5 else "user", text))
    rows += [(100, None, "user", "x"), (100, None, "a", "x"), (100, 0, None, None)]
    rows += [(101, 5, "user", "tie")] * 3 + [(None, 1, "user", "lost"), (205, 1, "u", "x" * 9000)]
    for c in range(300, 340):
        rows += [(c, t, "user", f"copy {t}") for t in range(10)]
    draw.shuffle(rows)
    return rows


def test_drawn_conversations(spark, drawn):
    check(spark, drawn)


def test_small_stretches_and_id_ranges(spark, drawn, monkeypatch):
    monkeypatch.setattr(trie, "STRETCH", 2)
    monkeypatch.setattr(trie, "IDS", 3)
    check(spark, drawn)


@pytest.mark.parametrize("block", [1, 3, 50])
def test_other_block_lengths(spark, drawn, monkeypatch, block):
    monkeypatch.setattr(trie, "BLOCK", block)
    check(spark, drawn)


def test_one_long_conversation(spark):
    rows = [(5, t, "user", f"turn {t % 7}") for t in range(3000)] + [(6, 0, "user", "turn 0")]
    got = nodes(spark, rows)
    assert len(got) == len(brute_depths(rows)) and max(r.depth for r in got) == 3000
    assert [r.n_leaves for r in got if r.depth == 3000] == [1]


def brute_depths(rows):
    """Depths of all nodes, without the sums below them."""
    import zlib

    own = {}
    for c, _, role, text in rows:
        own.setdefault(c, []).append((role, text))
    seen = {()}
    for c, turns in own.items():
        head = zlib.crc32(str(c).encode()) % 9
        whole = own.get(c - c % 5, [])[:head] + turns[head:]
        seen |= {tuple(whole[:d]) for d in range(len(whole) + 1)}
    return seen


def test_turnless_and_empty(spark):
    assert nodes(spark, []) == []
    alone = nodes(spark, [(7, 0, "user", "hello")])
    assert [tuple(r) for r in alone] == brute.conversation_nodes([(7, 0, "user", "hello")])
    assert nodes(spark, [(None, 0, "user", "x")]) == []


def test_blocks_without_siblings_are_not_grouped(spark):
    rows = [(c, t, "user", f"{t}") for c in range(0, 50, 5) for t in range(16)]
    ids, turns = trie.rebuilt(spark.createDataFrame(rows, SCHEMA))
    alone, others = trie.block_groups(trie.block_rows(turns))
    assert alone.count() == 4 and others.count() == 0


def test_extra_columns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "x", 3)], SCHEMA + ", place int")
    renamed = rows.withColumn("digest", F.lit("d"))
    assert trie.prefix_trie(*trie.rebuilt(renamed)).count() >= 1


def test_query_columns(spark):
    got = queries.QUERIES["op11_trie"](spark, "/root/testdata/sf0.001")
    assert {f.dataType.simpleString() for f in got.schema if f.name != "ends_sha256"} == {"bigint"}
