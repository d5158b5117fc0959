"""Exploratory tables over the curated postings: the numbers behind the usual charts."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.contract import MEASURE_COLUMNS, YEAR_COLUMN
from jobstrata.functions import share_percent
from jobstrata.operators.aggregates import mean_of_parts, mean_parts, rounded, with_numbers
from jobstrata.operators.percentiles import SINGLE_PASS_ROWS, grouped_percentiles, stored_rows

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
NUMERIC_COLUMNS = (YEAR_COLUMN, *MEASURE_COLUMNS)
_RISK = {"avg_automation_risk": ("automation_risk_score", 3)}


def salary_distribution(
    curated: DataFrame,
    *,
    known_rows: int | None = None,
    single_pass_rows: int = SINGLE_PASS_ROWS,
) -> DataFrame:
    """Box-plot statistics of the salary per industry, exact quartiles."""
    boxes = grouped_percentiles(
        stored_rows(curated.select("industry", "salary_usd"), known_rows, single_pass_rows),
        ["industry"],
        F.col("salary_usd"),
        QUARTILES,
        known_rows=known_rows,
        single_pass_rows=single_pass_rows,
    )
    return boxes.select(
        "industry",
        F.col("value_count").alias("salary_count"),
        rounded(F.col("value_min"), 2).alias("min_salary_usd"),
        *[rounded(F.col(name), 2).alias(f"{name}_salary_usd") for name in QUARTILES],
        rounded(F.col("value_max"), 2).alias("max_salary_usd"),
    )


def _mean_risk(curated: DataFrame, keys: list[str]) -> DataFrame:
    parts = [column.alias(name) for name, column in mean_parts(_RISK).items()]
    return (
        with_numbers(curated, ["automation_risk_score"])
        .groupBy(*keys)
        .agg(*parts, F.count(F.lit(1)).alias("job_count"))
        .select(
            *keys,
            mean_of_parts("avg_automation_risk", 3).alias("avg_automation_risk"),
            "job_count",
        )
    )


def risk_by_industry(curated: DataFrame) -> DataFrame:
    """Mean automation risk and postings per industry."""
    return _mean_risk(curated, ["industry"])


def risk_heatmap(curated: DataFrame) -> DataFrame:
    """Mean automation risk per industry and year, one row per cell."""
    return _mean_risk(curated, ["industry", YEAR_COLUMN])


def adoption_by_year(curated: DataFrame) -> DataFrame:
    """Share of postings per year that mention AI."""
    flagged = F.count(F.when(F.col("ai_mentioned") == "YES", 1))
    return curated.groupBy(YEAR_COLUMN).agg(
        F.count(F.lit(1)).alias("job_count"),
        rounded(share_percent(flagged, F.count(F.lit(1))), 2).alias("pct_ai_mentioned"),
    )


def measure_correlation(curated: DataFrame) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, one row per pair, 6 places.

    All pairs are computed in a single aggregate; its one-row result is unpivoted.
    """
    pairs = list(combinations(NUMERIC_COLUMNS, 2))
    wide = curated.agg(
        *[
            F.corr(F.col(left).cast("double"), F.col(right).cast("double")).alias(f"c{i}")
            for i, (left, right) in enumerate(pairs)
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(left).alias("measure_a"),
                F.lit(right).alias("measure_b"),
                F.round(f"c{i}", 6).alias("correlation"),
            )
            for i, (left, right) in enumerate(pairs)
        ]
    )
    return wide.select(F.inline(rows))
