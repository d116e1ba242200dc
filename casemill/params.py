"""Default parameters; every operator takes the ones it needs as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    # Thresholds and sizes that decide the results.
    # Summary tables
    top_products: int = 15
    top_issues: int = 15
    top_companies: int = 15
    top_states: int = 15
    share_rows: int = 10
    trend_keys: int = 10
    top_words: int = 30
    max_delay_days: int = 365
    max_words: int = 1000
    # Company risk
    risk_floor: int = 100
    risk_medium: float = 40.0
    risk_high: float = 70.0
    # Drivers
    driver_products: int = 10
    top_drivers: int = 25
    drivers_per_product: int = 3
    # Growth
    growth_floor: int = 1000
    rising: float = 5.0
    rising_fast: float = 25.0
    declining: float = -5.0
    declining_fast: float = -25.0
    # Forecast
    forecast_periods: int = 6
    training_years: int = 4
    holdout_months: int = 6
    trend_threshold: float = 5.0
    # Recommendations
    recommended_companies: int = 5
    recommended_products: int = 5
    recommended_issues: int = 7
    recommended_drivers: int = 5
    # Text models
    seed: int = 42
    confidence: float = 0.55
    alternatives: int = 2
    top_k_values: tuple[int, ...] = (1, 3, 5)
    min_class_rows: int = 50
    vocabulary: int = 20_000
    min_df: int = 3
    ngram_max: int = 2
    max_iter: int = 2000
    fits_at_once: int = 3
    tolerance: float = 1e-4  # relative gain of the objective at which fitting ends
    topics: int = 10
    topic_vocabulary: int = 10_000
    topic_min_df: int = 10
    topic_words: int = 15
    multi_issue_ratio: float = 0.35
    multi_issue_max: int = 3
    emerging_growth: float = 0.03
    rare_support: int = 50
    similar_rows: int = 5


DEFAULTS = Params()
