"""Row-wise steps: each is one narrow projection without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata.contract import (
    FLAG_COLUMNS,
    MEASURE_COLUMNS,
    RAW_COLUMNS,
    TEXT_COLUMNS,
    YEAR_COLUMN,
)
from jobstrata.functions import (
    CURATED_RISK,
    FUNCTIONAL_RISK,
    RiskTiers,
    clean_text,
    risk_tier,
    standard_flag,
    to_double,
    to_year,
)

RISK_SCORE = "automation_risk_score"


def _cleaned(name: str):
    column = F.col(name)
    if name == YEAR_COLUMN:
        column = to_year(column)
    elif name in MEASURE_COLUMNS:
        column = to_double(column)
    elif name in TEXT_COLUMNS:
        column = clean_text(column)
    elif name in FLAG_COLUMNS:
        column = standard_flag(column)
    return column.alias(name)


def curated_postings(raw: DataFrame) -> DataFrame:
    """Raw strings to the 23-column curated table: typed numbers, upper-cased text, YES/NO
    flags and the curated risk tier. One projection; ``salary_change_vs_prev_year_percent``
    stays text."""
    tier = risk_tier(to_double(F.col(RISK_SCORE)), CURATED_RISK)
    return raw.select(*[_cleaned(name) for name in RAW_COLUMNS], tier.alias("risk_category"))


def with_risk_tier(
    df: DataFrame, tiers: RiskTiers = FUNCTIONAL_RISK, score: str = RISK_SCORE
) -> DataFrame:
    """Add ``risk_category`` from a score column of text or numbers."""
    return df.withColumn("risk_category", risk_tier(to_double(F.col(score)), tiers))


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[name.lower() for name in df.columns])


def partition_last(df: DataFrame, *partition_columns: str) -> DataFrame:
    """Move the partition columns behind all others, as a positional insert needs them."""
    missing = [name for name in partition_columns if name not in df.columns]
    if missing:
        raise ValueError(f"no partition column {missing}")
    return df.select(*[c for c in df.columns if c not in partition_columns], *partition_columns)


def align_by_position(df: DataFrame, target: T.StructType) -> DataFrame:
    """Rename and cast to ``target`` by position; names are not compared, the number is."""
    if len(df.columns) != len(target.fields):
        raise ValueError(f"{len(df.columns)} columns given, {len(target.fields)} expected")
    return df.toDF(*target.names).select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in target.fields]
    )
