from jobstrata.functions.columns import (
    CURATED_RISK,
    FUNCTIONAL_RISK,
    RiskTiers,
    clean_text,
    is_flagged,
    risk_tier,
    share_percent,
    standard_flag,
    to_double,
    to_year,
)

__all__ = [
    "CURATED_RISK",
    "FUNCTIONAL_RISK",
    "RiskTiers",
    "clean_text",
    "is_flagged",
    "risk_tier",
    "share_percent",
    "standard_flag",
    "to_double",
    "to_year",
]
