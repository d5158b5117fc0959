import math
import random

from pyspark.sql import functions as F

from jobstrata.functions import (
    CURATED_RISK,
    FUNCTIONAL_RISK,
    clean_text,
    is_flagged,
    risk_tier,
    share_percent,
    standard_flag,
    to_double,
    to_year,
)
from jobstrata.operators.aggregates import rounded

NUMBER_TEXTS = [
    "2015", " 2015 ", "2015.7", "-2015.9", "1e3", ".5", ".", "5.", "+7", "99999999999",
    "NaN", "", "abc", "2015.7x", "\t12\n", "1_0", "0x10", "2015.7.1", "+", "-", "+.", "12d",
    "-.5", " 12", " .5 ", "2015 .7", "2147483647", "2147483648.9", "-2147483648", "--1",
    "Infinity", "12\u007f", None,
]


def _column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


def test_year_equals_the_non_ansi_cast(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        legacy = _column(spark, NUMBER_TEXTS, F.col("x").cast("int"))
        relaxed = _column(spark, NUMBER_TEXTS, to_year(F.col("x")))
        spark.conf.set("spark.sql.ansi.enabled", "true")
        strict = _column(spark, NUMBER_TEXTS, to_year(F.col("x")))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert dict(zip(NUMBER_TEXTS, strict)) == dict(zip(NUMBER_TEXTS, legacy))
    assert relaxed == strict


def test_year_equals_the_non_ansi_cast_on_random_texts(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices("0123459+-.. eE\tx", k=rng.randint(0, 8))) for _ in range(4000)]
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        legacy = _column(spark, texts, F.col("x").cast("int"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    ours = _column(spark, texts, to_year(F.col("x")))
    assert [row for row in zip(texts, ours, legacy) if row[1] != row[2]] == []
    assert sum(value is not None for value in legacy) > 200


def test_double_takes_malformed_text_as_null(spark):
    got = _column(spark, ["1.5", " 2 ", "x", "", "1e3", None, "NaN"], to_double(F.col("x")))
    assert got[:6] == [1.5, 2.0, None, None, 1000.0, None]
    assert math.isnan(got[6])


def test_text_is_trimmed_of_spaces_only(spark):
    got = _column(spark, ["  perú ", "\tx", None, " "], clean_text(F.col("x")))
    assert got == ["PERÚ", "\tX", None, ""]


def test_flags(spark):
    texts = ["True", "true", "1", "TRUE", "False", "0", "", " True", None]
    assert _column(spark, texts, standard_flag(F.col("x"))) == ["YES"] * 3 + ["NO"] * 6
    assert _column(spark, texts, is_flagged(F.col("x"))) == [1] + [None] * 8


def test_risk_tiers_at_the_cuts(spark):
    scores = ["0.7", "0.6999", "0.4", "0.3999", None, "bad", "NaN", "-1"]
    curated = _column(spark, scores, risk_tier(to_double(F.col("x")), CURATED_RISK))
    assert curated == ["ALTO", "MEDIO", "MEDIO", "BAJO", "BAJO", "BAJO", "ALTO", "BAJO"]
    scores = ["0.66", "0.6599", "0.33", "0.3299", None, "bad", "NaN", "-1"]
    functional = _column(spark, scores, risk_tier(to_double(F.col("x")), FUNCTIONAL_RISK))
    assert functional == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW", "LOW", "HIGH", "LOW"]


def test_share_and_rounding(spark):
    assert _column(spark, ["3"], share_percent(F.col("x").cast("long"), F.lit(8))) == [37.5]
    values = ["2.675", "0.125", "-0.125", "NaN", "1e30"]
    got = _column(spark, values, rounded(to_double(F.col("x")), 2))
    assert got[:3] == [2.68, 0.13, -0.13] and math.isnan(got[3]) and got[4] == 1e30
