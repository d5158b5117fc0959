import os
import math
import pytest
from pyspark.sql import functions as F

from jobstrata.contract import CURATED, FUNCTIONAL, GROUP_COLUMNS, RAW
from jobstrata.operators import aggregates, exploration, projections, quality
from jobstrata.plans.standin import postings

from small_data import SMALL_DATA

KEY = {
    "posting_year": "2020",
    "country": " peru ",
    "region": "la",
    "industry": "it",
    "seniority_level": "mid",
}


def test_curated_row(rows):
    got = projections.curated_postings(
        rows(
            {
                **KEY,
                "posting_year": "2020.9",
                "ai_mentioned": "1",
                "salary_usd": "N/A",
                "salary_change_vs_prev_year_percent": "3.5",
                "automation_risk_score": "0.7",
                "ai_keywords": "a, b",
            }
        )
    )
    assert got.schema.simpleString() == CURATED.simpleString()
    row = got.first()
    assert row.posting_year == 2020
    assert (row.country, row.industry) == ("PERU", "IT")
    assert (row.ai_mentioned, row.reskilling_required) == ("YES", "NO")
    assert row.salary_usd is None
    assert row.salary_change_vs_prev_year_percent == "3.5"
    assert (row.automation_risk_score, row.risk_category) == (0.7, "ALTO")
    assert row.ai_keywords == "a, b"


def test_positional_steps(spark):
    df = spark.createDataFrame([("1", "2", "3")], "A string, b string, C string")
    assert projections.lowercase_columns(df).columns == ["a", "b", "c"]
    assert projections.partition_last(df, "b").columns == ["A", "C", "b"]
    with pytest.raises(ValueError):
        projections.partition_last(df, "x")
    with pytest.raises(ValueError):
        projections.align_by_position(df, RAW)
    target = spark.createDataFrame([], "x int, y string, z double").schema
    assert projections.align_by_position(df, target).first() == (1, "2", 3.0)


def test_aggregate_of_hand_made_rows(rows):
    raw = rows(
        {**KEY, "salary_usd": "100", "automation_risk_score": "0.66", "ai_mentioned": "True"},
        {**KEY, "salary_usd": "200", "automation_risk_score": "0.9", "ai_mentioned": "true",
         "job_title": "x"},
        {**KEY, "salary_usd": "bad", "automation_risk_score": "NaN", "ai_mentioned": "1",
         "job_title": "x"},
        {**KEY, "country": None, "ai_intensity_score": "0.1235"},
    )
    got = {row.country: row for row in aggregates.impact_aggregate(raw).collect()}
    high = got[" peru "]
    assert high.risk_category == "HIGH"
    assert (high.avg_salary_usd, high.median_salary_usd) == (150.0, 150.0)
    assert str(high.avg_automation_risk) == "nan"
    assert high.avg_ai_intensity is None
    assert high.job_count == 3
    # Only the exact spelling counts, and titles are not made distinct.
    assert high.pct_ai_mentioned == 33.33
    assert high.unique_job_titles == 2
    low = got[None]
    assert (low.risk_category, low.avg_salary_usd, low.median_salary_usd) == ("LOW", None, None)
    assert (low.avg_ai_intensity, low.unique_job_titles) == (0.124, 0)


def test_one_answer_whatever_the_plan(spark, folder):
    """Stored landing rows through the single pass, the histogram with the built-in and the
    located ranks: equal cell for cell."""
    path = os.path.join(folder, "landing")
    postings(spark, SMALL_DATA).write.parquet(path)
    stored = spark.read.parquet(path)
    ways = [{"known_rows": 1 << 19}, {}, {"single_pass_rows": 0}]
    first, *others = [
        sorted(map(repr, aggregates.impact_aggregate(stored, **way).collect())) for way in ways
    ]
    assert first and all(other == first for other in others)


@pytest.mark.parametrize("way", [{"known_rows": 100}, {}, {"single_pass_rows": 0}])
def test_large_salaries_are_kept(spark, rows, way):
    def only(*salaries):
        raw = rows(*[{"salary_usd": s} for s in salaries])
        row = aggregates.impact_aggregate(raw, **way).first()
        return row.avg_salary_usd, row.median_salary_usd, row.job_count

    assert only("10", "1e12") == (500000000005.0, 500000000005.0, 2)
    assert only("10", "1e15", "1e15") == (666666666666670.0, 1e15, 3)
    assert only("1e25", "1e25") == (1e25, 1e25, 2)
    assert only("Infinity", "5", "6") == (math.inf, 6.0, 3)
    mean, middle, count = only("NaN", "5", "6")
    assert (math.isnan(mean), middle, count) == (True, 6.0, 3)


def test_text_is_parsed_once(spark):
    """Each measure is cast in one projection below the aggregate, whose scan is pruned."""
    aggregate = aggregates.impact_aggregate(postings(spark, SMALL_DATA), known_rows=6000)
    plan = aggregate._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Aggregate(" in line:
            assert "try_cast" not in line.split("output=")[0]


def test_exploration_of_an_empty_table(rows):
    curated = projections.curated_postings(rows())
    assert exploration.salary_distribution(curated).count() == 0
    assert exploration.salary_distribution(curated, single_pass_rows=0).count() == 0
    assert exploration.adoption_by_year(curated).count() == 0
    assert {row.correlation for row in exploration.measure_correlation(curated).collect()} == {None}


def test_structure_problems():
    assert quality.structure_problems([name.upper() for name in RAW.names]) == []
    assert quality.structure_problems(RAW.names[:-1]) == ["21 columns, 22 expected"]
    swapped = [RAW.names[1], RAW.names[0], *RAW.names[2:]]
    assert len(quality.structure_problems(swapped)) == 2


def test_refuse_empty_and_samples(spark, capsys):
    with pytest.raises(ValueError, match="gold is empty"):
        quality.refuse_empty(spark.range(0), "gold")
    assert quality.refuse_empty(spark.range(3)).count() == 3
    assert quality.sample_rows(spark.range(100)).count() == 10
    quality.preview(spark.createDataFrame([("x" * 60,)], "t string"))
    assert "x" * 60 in capsys.readouterr().out


def test_reconcile(spark):
    report = quality.reconcile(5, spark.range(4)).first()
    assert (report.source_rows, report.sink_rows, report.matches) == (5, 4, False)
    assert quality.reconcile(0, spark.range(0)).first().matches
