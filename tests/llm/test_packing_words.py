"""Ids of packed texts against the library, whatever the tokenizer file."""

import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobstrata.llm import packing, units

WORD_FILE, BYTE_FILE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
SIGNS = list("aAbBzZ.,.,  \n\t'sdtrevml0189-_éÉßñÜªºƏɐǅİıḰ̈﻿\xa0　日本①🙂ſDŽ")


def library(path, texts, end_id=2):
    tokenizer = Tokenizer.from_file(path)
    told = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*t.ids, end_id] for t in told]


def packed(kind, path, texts):
    maker = packing.spelled_by(path)
    assert type(maker) is kind
    ids, bounds = maker.ids(pa.array(texts, pa.string()), 2)
    assert ids.dtype == np.uint32
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def drawn(n=3000):
    draw = random.Random(4)
    texts = ["".join(draw.choices(SIGNS, k=draw.randrange(30))) for _ in range(n)]
    texts += [None, "", " ", ".", ",", ". .", "a.", "a,.", "don't I'LL 's", "x" * 20000, "<|endoftext|>."]
    return texts


def test_words_and_whole_texts_equal_the_library():
    texts = drawn()
    assert packed(packing.Words, WORD_FILE, texts) == library(WORD_FILE, texts)
    assert packed(packing.Whole, BYTE_FILE, texts) == library(BYTE_FILE, texts)
    assert packed(packing.Words, WORD_FILE, []) == []


def test_forgetting_words_changes_nothing(monkeypatch):
    words = packing.spelled_by(WORD_FILE)
    words.letters.most = words.others.most = 50
    monkeypatch.setattr(units, "LONGEST_KEPT", 3)
    texts = drawn(600)
    got = []
    for a in range(0, len(texts), 100):
        ids, bounds = words.ids(pa.array(texts[a : a + 100], pa.string()), 2)
        got += [ids[x:y].tolist() for x, y in zip(bounds[:-1], bounds[1:])]
    assert got == library(WORD_FILE, texts)


@pytest.mark.parametrize("path", [WORD_FILE, BYTE_FILE])
def test_pieces_of_any_tokenizer(spark, path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = dict(zip(texts, library(path, texts.values(), 7)))
    pieces = packing.pack(docs, path, 512, 7).withColumn("ids_crc32", F.crc32("ids"))
    assert set(brute.check_sequences(pieces.collect(), ids, 512)) == set(texts)


def test_other_forms_of_tokenizers_are_refused():
    from jobstrata.llm import alignment, tokens

    pieces = public_tokenizers.path("piece_bpe_32k.model")
    with pytest.raises(ValueError, match="no byte-level tokenizer"):
        tokens.Compiled(WORD_FILE)
    with pytest.raises(ValueError, match="no byte-level tokenizer"):
        alignment.Pair(WORD_FILE, pieces)


def test_memory_is_given_back_around_the_tokenizers_file(monkeypatch):
    order = []
    monkeypatch.setattr(packing, "_WORDS", {})
    monkeypatch.setattr(packing, "give_back", lambda: order.append("back"))
    monkeypatch.setattr(packing, "spelled_by", lambda path: order.append(path))
    monkeypatch.setattr(
        packing, "TaskContext", type("C", (), {"get": lambda: None or type("T", (), {"partitionId": lambda: 0})})
    )
    for _ in range(2):
        assert list(packing._pack_task(iter(()), "file", 8, 2)) == []
    assert order == ["back", "file", "back"]
