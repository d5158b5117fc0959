"""Column expressions of the cleaning and aggregation steps. Built-ins only.

No expression depends on the session's ANSI setting: malformed text becomes null, it
never raises.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flag spellings and risk cuts with their labels.
TRUE_SPELLINGS = ("True", "true", "1")
STRICT_TRUE = "True"


@dataclass(frozen=True)
class RiskTiers:
    """Lower bounds with labels, highest first, and the label below all of them."""

    cuts: tuple[tuple[float, str], ...]
    lowest: str


CURATED_RISK = RiskTiers(cuts=((0.7, "ALTO"), (0.4, "MEDIO")), lowest="BAJO")
FUNCTIONAL_RISK = RiskTiers(cuts=((0.66, "HIGH"), (0.33, "MEDIUM")), lowest="LOW")

# Optional sign, digits with an optional fraction, or a bare fraction; blanks and control
# characters around it are ignored.
_NUMBER_TEXT = r"^[\x00-\x20\x7f]*[+-]?(\d+(\.\d*)?|\.\d*)[\x00-\x20\x7f]*$"


def to_year(text: Column) -> Column:
    """Text to int: a fraction is cut off, anything else malformed is null.

    Equals the non-ANSI ``CAST(text AS INT)``; an exponent form is null.
    """
    whole = F.substring_index(text, ".", 1)
    return F.when(
        text.rlike(_NUMBER_TEXT),
        F.when(whole.rlike(r"\d"), whole.try_cast("int")).otherwise(0),
    )


def to_double(text: Column) -> Column:
    """Text to double, malformed text to null."""
    return text.try_cast("double")


def clean_text(text: Column) -> Column:
    """Trim spaces (U+0020 only) and upper-case."""
    return F.upper(F.trim(text))


def standard_flag(flag: Column) -> Column:
    """``YES`` for an accepted true spelling, ``NO`` for everything else, null included."""
    return F.when(flag.isin(*TRUE_SPELLINGS), "YES").otherwise("NO")


def is_flagged(flag: Column) -> Column:
    """1 for exactly ``True``, else null. Stricter than :func:`standard_flag`."""
    return F.when(flag == STRICT_TRUE, 1)


def risk_tier(score: Column, tiers: RiskTiers) -> Column:
    """Label of the highest cut not above ``score``; a null score gets the lowest label.

    NaN sorts above every number and gets the highest label.
    """
    (first_cut, first_label), *rest = tiers.cuts
    tier = F.when(score >= first_cut, first_label)
    for cut, label in rest:
        tier = tier.when(score >= cut, label)
    return tier.otherwise(tiers.lowest)


def share_percent(part: Column, whole: Column) -> Column:
    """``part / whole`` of two counts in percent, in double arithmetic."""
    return part.cast("double") / whole.cast("double") * 100
