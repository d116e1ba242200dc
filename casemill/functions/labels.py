"""Score-to-label ladders and safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from casemill.params import DEFAULTS, Params

# Fixed value: growth of a key that had no rows in the year before.
NEW_KEY_GROWTH = 999.0


def safe_growth(current: Column, previous: Column) -> Column:
    """Percent change; no previous value gives 0, growth from zero gives the marker 999."""
    return (
        F.when(previous.isNull(), 0.0)
        .when(previous == 0, F.when(current > 0, NEW_KEY_GROWTH).otherwise(0.0))
        .otherwise((current - previous) / previous * 100)
    )


def growth_label(growth: Column, p: Params = DEFAULTS) -> Column:
    return (
        F.when(growth == NEW_KEY_GROWTH, "New / Emerging")
        .when(growth >= p.rising_fast, "Rising Fast")
        .when(growth >= p.rising, "Rising")
        .when(growth <= p.declining_fast, "Declining Fast")
        .when(growth <= p.declining, "Declining")
        .otherwise("Stable")
    )


def risk_level(score: Column, p: Params = DEFAULTS) -> Column:
    return F.when(score >= p.risk_high, "High").when(score >= p.risk_medium, "Medium").otherwise("Low")


def trend_label(change: Column, p: Params = DEFAULTS) -> Column:
    return (
        F.when(change >= p.trend_threshold, "Increasing")
        .when(change <= -p.trend_threshold, "Decreasing")
        .otherwise("Stable")
    )


def forecast_quality(mape: Column) -> Column:
    return (
        F.when(mape < 10, "Excellent").when(mape < 20, "Good").when(mape < 30, "Acceptable").otherwise("Poor")
    )


def complexity(words: Column) -> Column:
    return F.when(words <= 50, "Low").when(words <= 150, "Medium").otherwise("High")


def min_max_scale(value: Column, low: Column, high: Column) -> Column:
    """Scale to 0..1; all values equal (or no value at all) gives 0."""
    return F.when(high > low, (value - low) / (high - low)).otherwise(0.0)


def whole_count(value: Column) -> Column:
    """Negative values to 0, halves to even, then an integer."""
    return F.bround(F.greatest(value, F.lit(0.0)), 0).cast("long")
