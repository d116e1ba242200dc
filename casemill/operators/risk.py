"""Company risk scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casemill.functions import labels
from casemill.operators.counts import Source, present, ranked
from casemill.operators.facts import as_facts
from casemill.params import DEFAULTS, Params

# Weights of the three scaled measures.
WEIGHTS = {"Complaint_Score": 0.50, "Untimely_Score": 0.30, "Delay_Score": 0.20}


def company_risk(source: Source, p: Params = DEFAULTS) -> DataFrame:
    """Volume, untimely share and mean delay per company, scaled over the companies above the floor.

    The bounds come as one scalar row from the same grouped table, which the plan computes once.
    """
    untimely = F.try_divide("timely_no", "timely_known") * 100
    delay = F.greatest(F.coalesce(F.try_divide("delay_sum", "delay_known"), F.lit(0.0)), F.lit(0.0))
    companies = (
        present(as_facts(source).by("Company"), "Company")
        .filter(F.col("rows") >= p.risk_floor)
        .select(
            "Company", F.col("rows").alias("Complaint_Count"), untimely.alias("Untimely_Response_Pct"),
            delay.alias("Avg_Resolution_Delay"),
        )
    )
    inputs = dict(zip(WEIGHTS, ("Complaint_Count", "Untimely_Response_Pct", "Avg_Resolution_Delay")))
    bounds = companies.agg(
        F.struct(*[f(c).alias(f"{c}_{n}") for c in inputs.values() for n, f in (("low", F.min), ("high", F.max))])
    ).scalar()
    scored = companies.withColumn("_bounds", bounds)
    for score, c in inputs.items():
        low, high = F.col(f"_bounds.{c}_low"), F.col(f"_bounds.{c}_high")
        scored = scored.withColumn(score, labels.min_max_scale(F.col(c), low, high))
    total = sum((F.col(s) * w for s, w in WEIGHTS.items()), F.lit(0.0)) * 100
    scored = scored.drop("_bounds").withColumn("Risk_Score", total)
    return ranked(scored.withColumn("Risk_Level", labels.risk_level(F.col("Risk_Score"), p)), "Risk_Score", "Company")


def risk_level_counts(risk: DataFrame) -> DataFrame:
    return ranked(risk.groupBy("Risk_Level").agg(F.count(F.lit(1)).alias("Count")), "Count", "Risk_Level")


def risk_factors(risk: DataFrame) -> DataFrame:
    """One row per company and score instead of one column per score."""
    return risk.unpivot(["Company"], list(WEIGHTS), "Factor", "Score")
