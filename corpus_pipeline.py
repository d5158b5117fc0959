"""Documents from raw rows to packed training sequences, in stages over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.llm import language, lines, mixing, neardup
from jobstrata.llm.common import read_table, stored, word_count
from jobstrata.llm.queries import packed_digest
from jobstrata.workspace import new_path, remove, scratch

# Below this belief in its language a document is not used.
MIN_LANGUAGE_SCORE = 0.34
# From this similarity on, in hundredths, documents are near-duplicates.
NEAR_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language.confident(docs, language.learn(docs), MIN_LANGUAGE_SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that occurred before; those that held nothing else go."""
    shorter = lines.remove_repeated_runs(docs)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = F.col("removed_lines") > 0
        shorter = shorter.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    left = (F.col("removed_lines") == 0) | (word_count(F.col("text")) > 0)
    return shorter.where(left).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the document with the smallest id."""
    found = neardup.near_duplicates(docs, NEAR_PERCENT)
    gone = found.where("NOT kept").select("doc_id").distinct()
    return docs.join(stored(gone, "near-duplicates"), "doc_id", "left_anti").select(*docs.columns)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix by source weights takes them."""
    return mixing.mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with checksums of their ids."""
    return packed_digest(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing_sources", mixing_sources),
    ("packing", packing),
]

# Trained models, signatures, seeded draws and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from the documents table. What a stage needs beside its output goes
    with its end, and its output once the next stage's is stored."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
