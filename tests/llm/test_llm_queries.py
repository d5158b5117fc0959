"""Registered queries against SQL, or against plain versions where SQL can't express them."""

from collections import Counter, defaultdict

import brute
import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from jobstrata.llm import language, queries

DATA = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "conversations")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*columns).collect())
    result = duck.execute(queries.ORACLE[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got and got == Counter(tuple(r[i] for i in order) for r in result.fetchall())


def test_language_of_held_out_documents(spark):
    data = DATA.replace("0.001", "0.01")
    found = queries.QUERIES["op1_language"](spark, data)
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang")
    held = found.join(docs, "doc_id").where("held_out")
    rows = held.agg(
        F.count("*").alias("n"),
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"),
        F.min("score").alias("low"),
        F.max("score").alias("high"),
    ).first()
    assert rows.n > 250 and rows.right > 0.95
    assert 0 <= rows.low <= rows.high <= 1
    assert found.count() == docs.count()


def test_languages_equal_a_plain_vote(spark, texts):
    """Features gram by gram, margins and votes one by one, from the learned weights."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = language.learn(docs)
    found = language.identify(docs, model, ["doc_id"]).collect()
    short = [r for r in found if len(texts[r.doc_id] or "") < 3000]
    assert len(short) > 100
    for r in short:
        lang, score = brute.language_of(texts[r.doc_id], model)
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-4)


def _sizes(text):
    return len(brute.WORD.findall(text or ""))


def test_mix_meets_targets(spark):
    data = DATA.replace("0.001", "0.01")
    query = queries.QUERIES["op4_mixing"]
    rows = query(spark, data).collect()
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    size = {r.doc_id: _sizes(r.text) for r in docs}
    source = {r.doc_id: r.source for r in docs}
    total, taken = Counter(), Counter()
    for doc, n in size.items():
        total[source[doc]] += n
    target = brute.mix_targets(total)
    assert sorted(r.doc_id for r in rows) == sorted(size)
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == total[source[r.doc_id]]
        assert r.target == pytest.approx(target[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[source[r.doc_id]] += r.taken
    for s in total:
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], 60)
    again = {(r.doc_id, r.taken) for r in query(spark, data).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_packing_round_trip(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    told = tokenizer.encode_batch([t or "" for t in texts.values()], add_special_tokens=False)
    ids = {d: [*t.ids, 2] for d, t in zip(texts, told)}
    rows = queries.QUERIES["op7_packing"](spark, DATA).collect()
    assert set(brute.check_sequences(rows, ids)) == set(texts)


def test_token_counts_equal_the_library(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in queries.QUERIES["op10_tokens"](spark, DATA).collect():
        text = texts[r.doc_id] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 512)


def test_pipeline_stages(spark, texts):
    """Every stage against a plain version of it, on what the stage before kept."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, DATA).cache()
        kept[name] = docs
        if name == "packing":
            continue
        assert docs.columns == columns and docs.schema == before.schema
    by_id = lambda name: {r.doc_id: r.text for r in kept[name].collect()}
    assert len(by_id("language_id")) > 0.98 * len(texts)
    assert by_id("language_id").items() <= texts.items()
    shorter = brute.without_repeated_runs(by_id("language_id"))
    assert by_id("line_dedup") == {
        d: t for d, (t, n) in shorter.items() if not n or brute.WORD.search(t)
    }
    component = brute.near_components(by_id("line_dedup"), 80)
    assert set(by_id("near_dedup")) == {d for d, c in component.items() if d == c}
    mixed = kept["mixing_sources"].collect()
    copies = Counter(r.doc_id for r in mixed)
    assert set(copies) <= set(by_id("near_dedup")) and max(copies.values()) <= 3
    total, longest = Counter(), Counter()
    for r in kept["near_dedup"].collect():
        total[r.source] += _sizes(r.text)
        longest[r.source] = max(longest[r.source], _sizes(r.text))
    words = defaultdict(int)
    for r in mixed:
        words[r.source] += _sizes(r.text)
    for source, target in brute.mix_targets(total).items():
        assert abs(words[source] - target) <= longest[source]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {
        r.doc_id: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 2] for r in mixed
    }
    pieces = brute.check_sequences(kept["packing"].collect(), ids)
    assert {d: sum(p.start == 0 for p in ps) for d, ps in pieces.items()} == dict(copies)
    for df in kept.values():
        df.unpersist()


def test_surrogates_replace_every_mention(spark, texts):
    import re

    patterns = (r"[\w.]+@[\w.]+\.\w+", r"\+1 \(\d{3}\) \d{3}-\d{4}", r"password=\S+")
    rows = queries.QUERIES["op6_surrogates"](spark, DATA).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for pattern in patterns:
        pairs = {}
        for r in rows:
            old, new = re.findall(pattern, texts[r.doc_id]), re.findall(pattern, r.text)
            assert len(old) == len(new)
            for a, b in zip(old, new):
                assert a != b and pairs.setdefault(a, b) == b
        assert len(set(pairs.values())) == len(pairs) and not set(pairs) & set(pairs.values())
    changed = [r for r in rows if r.text != texts[r.doc_id]]
    assert changed and all(r.n_entities > 0 for r in changed)


def test_a_run_leaves_only_what_its_result_needs(spark, folder, monkeypatch):
    """Outputs of stages go once the next one is stored, and their own steps with them."""
    import os

    from jobstrata import workspace

    monkeypatch.setattr(workspace, "work_folder", lambda spark: folder)
    pieces = corpus_pipeline.run(spark, DATA)
    left = {name.split("-")[0] for name in os.listdir(folder)}
    assert left <= {"mixing_sources", "packed"}
    assert pieces.count() > 100
