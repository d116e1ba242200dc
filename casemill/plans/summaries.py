"""All summary tables of one complaint table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame

from casemill.operators import counts, drivers, forecast, growth, recommend, risk, words
from casemill.operators.facts import CubeFacts, Facts, as_facts, cube
from casemill.params import DEFAULTS, Params
from casemill.session import stage, staged_tables_removed
from casemill.sources.complaints import NARRATIVE, save_summary, summary_path

RECOMMENDATION_SETS = (
    ("Company",), ("Product", "Issue", "Sub-issue"), ("Year", "Product"), ("Year", "Issue"), ("Year", "Month"),
)


class Analysis:
    """The chain from grouped counts to recommendations; each step is built when it is asked for."""

    def __init__(self, source: DataFrame | Facts, p: Params = DEFAULTS):
        self.facts, self.p = as_facts(source), p

    @cached_property
    def risk(self) -> DataFrame:
        return risk.company_risk(self.facts, self.p)

    @cached_property
    def drivers(self) -> DataFrame:
        return drivers.all_drivers(self.facts)

    @cached_property
    def top_drivers(self) -> DataFrame:
        return drivers.top_drivers(self.drivers, self.p)

    @cached_property
    def product_growth(self) -> DataFrame:
        return growth.yoy_growth(self.facts, "Product", self.p)

    @cached_property
    def issue_growth(self) -> DataFrame:
        return growth.yoy_growth(self.facts, "Issue", self.p)

    @cached_property
    def monthly(self) -> DataFrame:
        return growth.monthly_trend(self.facts)

    @cached_property
    def forecast(self) -> DataFrame:
        return forecast.forecast(self.monthly, p=self.p)

    @cached_property
    def forecast_summary(self) -> DataFrame:
        return forecast.forecast_summary(self.monthly, p=self.p)

    @cached_property
    def recommendation_rows(self) -> DataFrame:
        return recommend.all_rows(
            self.risk, self.top_drivers, self.product_growth, self.issue_growth, self.forecast_summary, self.p
        )


def staged_analysis(df: DataFrame, p: Params = DEFAULTS) -> Analysis:
    """An analysis over a cube of just the sets that recommendations need: the rows are read once."""
    return Analysis(cube(df, RECOMMENDATION_SETS), p)


def count_tables(facts: Facts, p: Params = DEFAULTS) -> dict[str, DataFrame]:
    """The summaries that follow from counts alone."""
    timely, response = "Timely response?", "Company response to consumer"
    top = p.trend_keys
    return {
        "kpis": counts.kpis(facts),
        "yearly_trend": counts.yearly_trend(facts),
        "timely_response": counts.value_counts(facts, timely, "Timely Response"),
        "submitted_via": counts.value_counts(facts, "Submitted via", "Channel"),
        "consumer_group": counts.value_counts(facts, "Consumer_Group", "Consumer Group"),
        "top_products": counts.value_counts(facts, "Product", k=p.top_products),
        "product_share": counts.shares(facts, "Product", k=p.share_rows),
        "year_product_trend": counts.trend_by(facts, "Product"),
        "top_issues": counts.value_counts(facts, "Issue", k=p.top_issues),
        "top_sub_issues": counts.value_counts(facts, "Sub-issue", "Sub Issue", k=p.top_issues),
        "issue_product_heatmap": counts.cross_counts(facts, ["Issue", "Product"], top={"Issue": top, "Product": top}),
        "issue_trend": counts.trend_by(facts, "Issue", top),
        "top_companies": counts.value_counts(facts, "Company", k=p.top_companies),
        "company_share": counts.shares(facts, "Company", k=p.share_rows),
        "company_timely_response": counts.cross_counts(facts, ["Company", timely], top={"Company": top}),
        "company_resolution": counts.cross_counts(facts, ["Company", response], top={"Company": top}),
        "credit_bureau_summary": counts.name_match_summary(facts, "experian|equifax|transunion"),
        "resolution_summary": counts.value_counts(facts, response, "Resolution Type"),
        "resolution_by_year": counts.cross_counts(facts, ["Year", response]),
        "narrative_availability": counts.value_counts(facts, "Has_Narrative", "Has Narrative"),
        "narrative_length_trend": counts.narrative_length_trend(facts),
        "narrative_product_length": counts.narrative_length_by(facts, "Product", p.top_products),
        "narrative_product_availability": counts.narrative_availability_by(facts, "Product", p.top_products),
        "top_states": counts.value_counts(facts, "State", k=p.top_states),
        "state_map": counts.value_counts(facts, "State"),
    }


def analysis_tables(a: Analysis) -> dict[str, DataFrame]:
    rows = stage(a.recommendation_rows, "recommendations")
    return {
        "company_risk_score": a.risk,
        "driver_analysis": drivers.drivers_of_top_products(a.facts, a.p),
        "top_complaint_drivers": a.top_drivers,
        "product_driver_summary": drivers.top_drivers_per_product(a.drivers, a.p),
        "product_growth": a.product_growth,
        "issue_growth": a.issue_growth,
        "monthly_complaint_trend": a.monthly,
        "complaint_forecast": a.forecast,
        "forecast_summary": a.forecast_summary,
        "recommendations": recommend.recommendations(rows),
        "executive_action_plan": recommend.action_plan(rows),
    }


def row_tables(df: DataFrame, p: Params = DEFAULTS) -> dict[str, DataFrame]:
    """The summaries that need the rows themselves."""
    tables = {
        "delay_distribution": counts.delay_distribution(df, p),
        "narrative_word_count": counts.narrative_word_counts(df, p),
        "narrative_complexity": counts.narrative_complexity(df),
    }
    if NARRATIVE in df.columns:
        tables["top_narrative_words"] = words.top_words(df, NARRATIVE, p.top_words)
    return tables


def run_all(df: DataFrame, p: Params = DEFAULTS, folder: str | None = None) -> dict[str, DataFrame]:
    """All 40 summaries of a processed complaint table; written to ``folder`` if one is given.

    The 36 tables that follow from counts share one cube, so ``df`` is read once for them and once more for
    each of the tables that need rows. ``df`` should be a stored table; a derived one is better staged first. With a
    ``folder`` the staged tables are removed once all are written, and the written ones are returned.
    """
    if not folder:
        return _tables(df, p)
    with staged_tables_removed(df.sparkSession):
        tables = _tables(df, p)
        save_all(tables, folder)
    return {name: df.sparkSession.read.parquet(summary_path(folder, name)) for name in tables}


def _tables(df: DataFrame, p: Params) -> dict[str, DataFrame]:
    shared: CubeFacts = cube(df)
    return {**count_tables(shared, p), **analysis_tables(Analysis(shared, p)), **row_tables(df, p)}


def save_all(tables: dict[str, DataFrame], folder: str, at_once: int = 8) -> None:
    """The tables do not depend on each other, so several write jobs are submitted at the same time."""
    with ThreadPoolExecutor(at_once) as pool:
        jobs = [pool.submit(save_summary, table, folder, name) for name, table in tables.items()]
        for job in jobs:
            job.result()
