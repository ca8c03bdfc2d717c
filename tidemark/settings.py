"""Run settings. Every literal that a rule depends on is a field here."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


def _tiers() -> dict[str, int]:
    return {"Star": 1, "Nova": 2, "Aurora": 3}


def _education() -> dict[str, int]:
    return {"High School or Below": 1, "College": 2, "Bachelor": 3, "Master": 4, "Doctor": 5}


def _provinces() -> dict[str, int]:
    return {
        "Ontario": 1, "British Columbia": 2, "Quebec": 3, "Alberta": 4,
        "Manitoba": 5, "New Brunswick": 6, "Nova Scotia": 7, "Saskatchewan": 8,
        "Newfoundland": 9, "Yukon": 10, "Prince Edward Island": 11,
    }


def _province_flags() -> dict[str, str]:
    return {
        "is_ontario": "Ontario", "is_bc": "British Columbia",
        "is_quebec": "Quebec", "is_alberta": "Alberta",
    }


@dataclass(frozen=True)
class Settings:
    """Defaults are the published programme's; `testbed()` fits the sample tables."""

    prediction_date: str = "2017-12-31"
    feature_year: int = 2017
    label_year: int = 2018
    # first cancellation year that counts as churn; None counts every cancellation
    hard_churn_year: int | None = 2018
    early_member_year: int = 2014
    recent_member_year: int = 2017
    promo_label: str = "Promotion"
    # compare gender, marital status and enrollment type whatever their case
    ignore_case: bool = False
    # "recorded": last month with a row; "flown": last month with a flight
    recency_basis: str = "recorded"
    lookback_months: int = 6
    tier_levels: Mapping[str, int] = field(default_factory=_tiers)
    education_levels: Mapping[str, int] = field(default_factory=_education)
    province_codes: Mapping[str, int] = field(default_factory=_provinces)
    province_flags: Mapping[str, str] = field(default_factory=_province_flags)
    risk_cuts: tuple[float, float] = (0.40, 0.70)
    revenue_factor: float = 0.82
    save_rate: float = 0.27
    seed: int = 42
    test_share: float = 0.2

    @staticmethod
    def testbed() -> Settings:
        """Years and places of the sample order tables (see sources/testbed.py)."""
        names = [f"NATION_{i}" for i in range(11)]
        return Settings(
            prediction_date="2000-12-31",
            feature_year=2000,
            label_year=2001,
            hard_churn_year=2001,
            early_member_year=1995,
            recent_member_year=1997,
            province_codes={n: i + 1 for i, n in enumerate(names)},
            province_flags=dict(zip(_province_flags(), names)),
        )
