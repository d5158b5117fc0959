"""Aligned tokens against a plain walk over the libraries' tokens."""

import random

import brute
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobstrata.llm import alignment, queries, units

DATA = "/root/testdata/sf0.001"
PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
SIGNS = list(" \n\t\r\x0b\x1c\x85\xa0     　") + list(
    "abcdefgAB'sre  .,;-0123éßñü日本語한국①🙂́​﻿\x00%€"
)


def check(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r[0]: tuple(r[2:]) for r in alignment.align(rows, *PATHS).collect()}
    assert [got[i] for i in range(len(texts))] == brute.aligned(texts, *PATHS)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    want = brute.aligned([r.text for r in docs], *PATHS)
    got = queries.QUERIES["op12_alignment"](spark, DATA).collect()
    assert {tuple(r) for r in got} == {(d.doc_id, *w) for d, w in zip(docs, want)}
    assert sum(r.n_best for r in got) > 0


def test_odd_texts(spark):
    check(
        spark,
        [
            *(None, "", " ", "  ", "\n", "a", "a ", " a", "a\n b", "a  b   ", "a▁b", "▁"),
            *("<|endoftext|>", "a<s></s> b", "<0x41>", "don't I'll", "x" * 3000, "日本 語 " * 9),
            *("good one", "good ▁", "good one"),
        ],
    )


def test_random_texts(spark):
    draw = random.Random(11)
    check(spark, ["".join(draw.choices(SIGNS, k=draw.randrange(60))) for _ in range(700)])


def test_long_texts_in_stretches(monkeypatch):
    draw = random.Random(3)
    words = ["".join(draw.choices(SIGNS[14:], k=draw.randrange(1, 9))) for _ in range(300)]
    texts = [" ".join(draw.choices(words, k=n)) for n in (3, 900, 4, 0, 700, 1)]
    texts += [texts[1] + "▁ end", "x" * 2000]
    monkeypatch.setattr(alignment, "STRETCH_BYTES", 1000)
    pair, sums = alignment.Pair(*PATHS), alignment._Sums()
    parts = list(alignment._rows(pair, pa.array(texts, pa.string()), sums))
    got = []
    for a, b, columns in parts:
        names = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")
        got += list(zip(*(columns[n].to_pylist() for n in names)))
    assert len(parts) > 3 and int(sums.total()[1].sum()) == sum(g[3] for g in got)
    assert got == [(*w[:4], w[6]) for w in brute.aligned(texts, *PATHS)]


def test_remembered_units_are_bounded(monkeypatch):
    monkeypatch.setattr(units, "UNITS_KEPT", 40)
    pair = alignment.Pair(*PATHS)
    for n in range(5):
        texts = [f"w{i} " + "long" * 30 + f" {n}" for i in range(n * 20, n * 20 + 60)]
        data, bounds = units.spaced(pa.array(texts))
        found = pair.aligned(data, bounds)
        want = brute.aligned(texts, *PATHS)
        assert found["n_a"].tolist() == [w[0] for w in want]
        assert found["n_b"].tolist() == [w[1] for w in want]
    assert len(pair.ids_a.place) < 200


def test_columns_and_empty_tables(spark):
    rows = spark.createDataFrame(
        [(1, "a b", 7, "x"), (1, "a b", 7, "x"), (None, None, None, None)],
        "doc_id long, text string, n_a int, code string",
    )
    out = alignment.align(rows, *PATHS)
    assert out.columns == ["doc_id", "text", "code", *alignment._OUTPUT]
    got = sorted(out.collect(), key=str)
    assert got[0] == got[1] or got[1] == got[2]
    assert out.where("doc_id = 1").agg(F.sum("count_sum")).first()[0] == 2 * 2 * 2
    assert alignment.align(rows.limit(0), *PATHS).count() == 0


def test_pairs_are_bounded(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    pairs = set()
    pair = alignment.Pair(*PATHS)
    texts = [r.text for r in docs.select("text").collect()]
    data, bounds = units.spaced(pa.array(texts))
    pairs |= set(map(tuple, pair.aligned(data, bounds)["links"].tolist()))
    assert 0 < len(pairs) < alignment.pair_bound(*PATHS)
    spelled = pair.spelled_b.to_pylist()
    tokens = {i: t for t, i in pair.a.get_vocab().items()}
    sign = alignment._byte_signs()
    for a, b in list(pairs)[:2000]:
        left = bytes(sign[c] for c in tokens[a])
        assert left.endswith(spelled[b]) or spelled[b].endswith(left)


@pytest.mark.parametrize("text", ["a\xa0 b", "a  b c", "a\x85 b", "a　 b", "é b", "  b"])
def test_units_end_before_blanks_behind_other_signs(text):
    data, bounds = units.spaced(pa.array([text]))
    starts = units.unit_starts(data, bounds)
    raw = data.tobytes()
    for s in starts.tolist()[1:]:
        before = raw[:s].decode()
        assert raw[s : s + 1] == b" " and not before[-1].isspace()
