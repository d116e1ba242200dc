"""Year-over-year growth and the monthly trend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casemill.functions import dates, labels
from casemill.operators.counts import Source, present, ranked
from casemill.operators.facts import as_facts
from casemill.params import DEFAULTS, Params


def complete_years(counts: DataFrame) -> Column:
    """Scalar array ``[latest, previous]``: the two last years present below the last one, which may be
    partial. An error if there are fewer."""
    years = F.sort_array(F.collect_set("Year"), asc=False)
    checked = F.when(F.size(years) >= 3, F.slice(years, 2, 2)).otherwise(
        F.raise_error(F.lit("Not enough complete years available for growth analysis."))
    )
    return counts.select("Year").distinct().agg(checked).scalar()


def yoy_growth(source: Source, key: str, p: Params = DEFAULTS) -> DataFrame:
    """Counts of the last two complete years per key, growth and its label, for keys above the floor.

    Rows are counted once per year and key; the years and both counts come from that small table.
    """
    counts = present(as_facts(source).by("Year", key), "Year").select("Year", key, "rows")
    years = complete_years(counts)
    both = present(counts, key).withColumn("_years", years)
    latest, previous = F.col("_years")[0], F.col("_years")[1]

    def rows_of(year: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("Year") == year, F.col("rows"))), F.lit(0)).cast("long")

    table = both.groupBy(key).agg(
        rows_of(previous).alias("Previous_Year_Complaints"),
        rows_of(latest).alias("Current_Year_Complaints"),
        F.first(previous).alias("Previous_Year"),
        F.first(latest).alias("Current_Year"),
    )
    growth = labels.safe_growth(F.col("Current_Year_Complaints"), F.col("Previous_Year_Complaints"))
    table = (
        table.filter(F.col("Current_Year_Complaints") >= p.growth_floor)
        .withColumn("YoY_Growth_Pct", growth)
        .withColumn("Growth_Label", labels.growth_label(F.col("YoY_Growth_Pct"), p))
    )
    return ranked(table, "YoY_Growth_Pct", key)


def emerging(growth: DataFrame, floor: int = 0) -> DataFrame:
    """Keys without rows in the year before and at least ``floor`` rows in the current one."""
    new = F.col("Growth_Label") == "New / Emerging"
    return growth.filter(new & (F.col("Current_Year_Complaints") >= floor))


def monthly_trend(source: Source) -> DataFrame:
    rows = present(as_facts(source).by("Year", "Month"), "Year", "Month")
    return rows.select(
        "Year", "Month", F.col("rows").alias("Complaints"),
        dates.period_label(F.col("Year"), F.col("Month")).alias("Period"),
    ).orderBy("Year", "Month")
