"""The functional aggregate and its parts.

Means and roundings are exact: inputs go through DECIMAL(28, 6), so that sums do not depend
on row order, nor on the plan that a size calls for, and ties round alike everywhere. What
does not fit, from 10^22 up, and NaN and infinities are summed as doubles and added: a group
that holds NaN or an infinity has the mean that doubles give.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata.contract import FUNCTIONAL, GROUP_COLUMNS, MEASURE_COLUMNS
from jobstrata.functions import (
    FUNCTIONAL_RISK,
    is_flagged,
    risk_tier,
    share_percent,
    to_double,
)
from jobstrata.operators.percentiles import (
    SINGLE_PASS_ROWS,
    grouped_percentiles,
    reads_once,
    stored_rows,
)
from jobstrata.operators.projections import RISK_SCORE

# Output column -> (input column, decimals).
MEANS = {
    "avg_salary_usd": ("salary_usd", 2),
    "avg_ai_intensity": ("ai_intensity_score", 3),
    "avg_automation_risk": ("automation_risk_score", 3),
    "avg_displacement_risk": ("ai_job_displacement_risk", 3),
}
EXACT = "decimal(28,6)"


def with_numbers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add every measure as a number, so that text is parsed once however often the number is
    used. Malformed text is null. Read the columns with :func:`number`."""
    df = df.withColumns({f"_double_{name}": to_double(F.col(name)) for name in names})
    return _with_decimals(df, names)


def _with_decimals(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({f"_decimal_{name}": _fitting(number(name)) for name in names})


def number(name: str, kind: str = "double") -> Column:
    """A measure added by :func:`with_numbers`, as ``double`` or, where it fits, ``decimal``."""
    return F.col(f"_{kind}_{name}")


def _fitting(value: Column) -> Column:
    # Infinities are kept from the cast, which raises on them.
    return F.when(F.abs(value) < 1e22, value).try_cast(EXACT)


def rounded(value: Column, digits: int) -> Column:
    """Round half up to ``digits`` places, as a double; what does not fit a decimal has no
    places left to round."""
    return F.coalesce(F.round(_fitting(value), digits).cast("double"), value)


def mean_parts(means=MEANS) -> dict[str, Column]:
    """Additive parts of the means, after :func:`with_numbers`: an exact sum, the sum of what
    does not fit and a non-null count per output column."""
    parts = {}
    for output, (name, _) in means.items():
        exact, value = number(name, "decimal"), number(name)
        parts[f"{output}_sum"] = F.sum(exact)
        parts[f"{output}_rest"] = F.sum(F.when(exact.isNull(), value))
        parts[f"{output}_n"] = F.count(value)
    return parts


def mean_of_parts(output: str, digits: int) -> Column:
    """Rounded mean from its parts; null where no value was counted."""
    total, rest = F.col(f"{output}_sum"), F.col(f"{output}_rest")
    count = F.nullif(F.col(f"{output}_n"), F.lit(0))
    whole = count.cast("decimal(18,0)")
    # The narrower type leaves the quotient more places to round from.
    narrow = F.round(total.try_cast(EXACT) / whole, digits).cast("double")
    exact = F.coalesce(narrow, F.round(total / whole, digits).cast("double"))
    loose = (F.coalesce(total.cast("double"), F.lit(0.0)) + rest) / count
    return F.when(rest.isNull(), exact).otherwise(loose)


def group_keys(df: DataFrame, keys: Sequence[str] = GROUP_COLUMNS) -> DataFrame:
    """Distinct key combinations; null is a key value like any other."""
    return df.select(*keys).distinct()


def group_means(df: DataFrame, keys: Sequence[str] = GROUP_COLUMNS) -> DataFrame:
    """Rounded means of the four measures per group; null where a group has no number."""
    return (
        with_numbers(df, MEASURE_COLUMNS)
        .groupBy(*keys)
        .agg(*[column.alias(name) for name, column in mean_parts().items()])
        .select(
            *keys,
            *[mean_of_parts(out, places).alias(out) for out, (_, places) in MEANS.items()],
        )
    )


def group_median(
    df: DataFrame,
    keys: Sequence[str] = GROUP_COLUMNS,
    *,
    known_rows: int | None = None,
    single_pass_rows: int = SINGLE_PASS_ROWS,
) -> DataFrame:
    """Exact interpolated median salary per group, rounded to 2 places.

    ``known_rows`` and ``single_pass_rows`` as in :func:`grouped_percentiles`.
    """
    rows = df.select(*keys, to_double(F.col("salary_usd")).alias("_salary"))
    medians = grouped_percentiles(
        stored_rows(rows, known_rows, single_pass_rows),
        keys,
        F.col("_salary"),
        {"median": 0.5},
        known_rows=known_rows,
        single_pass_rows=single_pass_rows,
    )
    return medians.select(*keys, rounded(F.col("median"), 2).alias("median_salary_usd"))


def group_count(df: DataFrame, keys: Sequence[str] = GROUP_COLUMNS) -> DataFrame:
    """Rows per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("job_count"))


def pct_flagged(df: DataFrame, keys: Sequence[str] = GROUP_COLUMNS) -> DataFrame:
    """Share of rows whose ``ai_mentioned`` is exactly ``True``, in percent, 2 places."""
    share = share_percent(F.count(is_flagged(F.col("ai_mentioned"))), F.count(F.lit(1)))
    return df.groupBy(*keys).agg(rounded(share, 2).alias("pct_ai_mentioned"))


def nonnull_titles(df: DataFrame, keys: Sequence[str] = GROUP_COLUMNS) -> DataFrame:
    """Non-null job titles per group. The column keeps its established name
    ``unique_job_titles`` although titles are not made distinct."""
    return df.groupBy(*keys).agg(F.count("job_title").alias("unique_job_titles"))


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def impact_input(raw: DataFrame) -> tuple[DataFrame, Column]:
    """Postings with numbers and tier, and the column whose median is taken."""
    parsed = with_numbers(raw, MEASURE_COLUMNS)
    tier = risk_tier(number(RISK_SCORE), FUNCTIONAL_RISK)
    return parsed.withColumn("risk_category", tier), number("salary_usd")


def impact_parts() -> dict[str, Column]:
    """Additive aggregates of the functional table, over :func:`impact_input`."""
    return {
        **mean_parts(),
        "job_count": F.count(F.lit(1)),
        "flagged": F.count(is_flagged(F.col("ai_mentioned"))),
        "unique_job_titles": F.count("job_title"),
    }


def impact_table(summary: DataFrame) -> DataFrame:
    """The functional table from added up parts and the median."""
    computed = {
        **{out: mean_of_parts(out, places) for out, (_, places) in MEANS.items()},
        "median_salary_usd": rounded(F.col("median"), 2),
        "pct_ai_mentioned": rounded(share_percent(F.col("flagged"), F.col("job_count")), 2),
    }
    return summary.select(
        *[computed.get(name, F.col(name)).alias(name) for name in FUNCTIONAL.names]
    )


def impact_aggregate(
    raw: DataFrame,
    *,
    known_rows: int | None = None,
    single_pass_rows: int = SINGLE_PASS_ROWS,
) -> DataFrame:
    """The 14-column functional table over raw postings.

    Keys are the raw texts and the functional risk tier. Means and counts share one shuffle.
    Where the input is read several times, its keys and parsed numbers are stored first. See
    :func:`nonnull_titles` for ``unique_job_titles`` and :func:`grouped_percentiles` for
    ``known_rows`` and ``single_pass_rows``.
    """
    rows, salary = impact_input(raw)
    if not reads_once(known_rows, single_pass_rows):
        # Titles are only counted, and decimals are cheaper made again than stored.
        titled = F.when(F.col("job_title").isNotNull(), True).alias("job_title")
        numbers = [number(name) for name in MEASURE_COLUMNS]
        rows = rows.select(*GROUP_COLUMNS, *numbers, "ai_mentioned", titled)
        rows = _with_decimals(stored_rows(rows, known_rows, single_pass_rows), MEASURE_COLUMNS)
    return impact_table(
        grouped_percentiles(
            rows,
            GROUP_COLUMNS,
            salary,
            {"median": 0.5},
            impact_parts(),
            known_rows=known_rows,
            single_pass_rows=single_pass_rows,
        )
    )
