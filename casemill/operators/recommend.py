"""Rule-based recommendations from the summary tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from casemill.functions.text import two_decimals
from casemill.operators.counts import ranked
from casemill.params import DEFAULTS, Params

# Keyword groups and the advice of the first group that matches.
ISSUE_ADVICE = (
    (("fraud", "unauthorized", "scam"),
     "Strengthen fraud detection rules, improve transaction verification, monitor suspicious activity patterns, "
     "and create a faster fraud-dispute workflow."),
    (("credit report", "incorrect information", "report"),
     "Audit credit reporting data pipelines, improve bureau reporting accuracy, reduce dispute resolution delays, "
     "and strengthen data quality controls."),
    (("debt", "collect"),
     "Review debt validation workflows, monitor collection communication practices, and ensure collectors follow "
     "proper documentation and compliance procedures."),
    (("mortgage", "foreclosure"),
     "Improve mortgage servicing communication, review foreclosure prevention workflows, and strengthen hardship "
     "assistance support."),
    (("payment", "funds", "transaction"),
     "Investigate payment processing failures, improve transaction status visibility, and reduce delays in fund "
     "availability and dispute handling."),
    (("disclosure", "confusing"),
     "Simplify customer disclosures, improve fee and policy communication, and review customer-facing documentation "
     "for clarity."),
    (("service", "account"),
     "Improve customer service escalation paths, reduce response time, and create clearer account-resolution "
     "playbooks."),
)
ISSUE_DEFAULT = (
    "Perform root-cause analysis, identify process gaps, and create a targeted resolution playbook for this "
    "complaint category."
)
PRODUCT_ADVICE = (
    (("credit reporting",),
     "Prioritize credit reporting quality audits, improve dispute handling, and monitor bureau-related complaint "
     "drivers."),
    (("debt collection",),
     "Review collection practices, strengthen debt validation checks, and monitor communication-related complaints."),
    (("mortgage",),
     "Improve loan servicing transparency, strengthen foreclosure assistance, and review hardship support workflows."),
    (("money transfer", "virtual currency"),
     "Strengthen transaction monitoring, fraud controls, refund workflows, and digital wallet support processes."),
    (("checking", "savings"),
     "Review overdraft, account access, fee, and fund availability processes."),
)
PRODUCT_DEFAULT = (
    "Investigate top issues within this product and allocate monitoring resources to the fastest-growing complaint "
    "areas."
)
RISK_ADVICE = (
    "Prioritize this company for operational review, audit response delays, improve SLA compliance, and investigate "
    "complaint handling bottlenecks."
)
FORECAST_ADVICE = {
    "Increasing": ("High",
                   "Complaint volume is expected to increase. Increase complaint handling capacity, prepare support "
                   "teams for higher workload, and monitor fast-growing products and issues."),
    "Decreasing": ("Low",
                   "Complaint volume is expected to decrease. Maintain current monitoring, but continue focusing on "
                   "high-risk companies and major complaint drivers."),
}
FORECAST_DEFAULT = (
    "Medium",
    "Complaint volume is expected to remain stable. Maintain current capacity and continue monitoring risk and "
    "growth signals.",
)
DRIVER_SUFFIX = (
    " This driver has high complaint volume, so it should be treated as a priority root-cause area."
)
FORECAST_ENTITY = "Overall Complaint Volume"
PRIORITIES = ("High", "Medium", "Low")
ACTION_ORDER = ("Forecast", "Company Risk", "Complaint Driver", "Issue Growth", "Product Growth")
COLUMNS = ("Category", "Priority", "Entity", "Signal", "Recommendation")


def advice(text: Column, rules: Sequence[tuple[Sequence[str], str]], default: str) -> Column:
    """The text of the first rule with a keyword in ``text``, whatever its case."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    result = F.lit(default)
    for keywords, answer in reversed(rules):
        found = reduce(lambda a, b: a | b, [lowered.contains(k) for k in keywords])
        result = F.when(found, answer).otherwise(result)
    return result


def issue_advice(text: Column) -> Column:
    return advice(text, ISSUE_ADVICE, ISSUE_DEFAULT)


def product_advice(text: Column) -> Column:
    return advice(text, PRODUCT_ADVICE, PRODUCT_DEFAULT)


def _rows(df: DataFrame, category: str, priority: Column, entity: Column, signal: Column, text: Column,
          order: Sequence[Column]) -> DataFrame:
    """``df`` is already cut to a few rows, so the sequence within the category is a small window."""
    df = df.withColumn("_cat", F.lit(category))
    return df.select(
        F.col("_cat").alias("Category"), priority.alias("Priority"), entity.alias("Entity"),
        signal.alias("Signal"), text.alias("Recommendation"),
        F.row_number().over(W.partitionBy("_cat").orderBy(*order)).alias("_seq"),
    )


def risk_rows(risk: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    high = risk.filter(F.col("Risk_Level") == "High")
    high = ranked(high, "Risk_Score", "Company").limit(p.recommended_companies)
    signal = F.concat(
        F.lit("Risk Score: "), two_decimals(F.col("Risk_Score")),
        F.lit(" | Complaints: "), F.col("Complaint_Count").cast("string"),
        F.lit(" | Untimely Response: "), two_decimals(F.col("Untimely_Response_Pct")), F.lit("%"),
    )
    return _rows(high, "Company Risk", F.lit("High"), F.col("Company"), signal, F.lit(RISK_ADVICE),
                 [F.desc("Risk_Score"), F.asc("Company")])


def growth_rows(growth: DataFrame, key: str, category: str, priority: str, k: int, text: Column) -> DataFrame:
    top = ranked(growth, "YoY_Growth_Pct", key).limit(k)
    signal = F.concat(
        F.lit("YoY Growth: "), two_decimals(F.col("YoY_Growth_Pct")),
        F.lit("% | Current Complaints: "), F.col("Current_Year_Complaints").cast("string"),
    )
    return _rows(top, category, F.lit(priority), F.col(key), signal, text, [F.desc("YoY_Growth_Pct"), F.asc(key)])


def forecast_rows(summary: DataFrame) -> DataFrame:
    trend = F.col("Forecast_Trend")
    priority, text = F.lit(FORECAST_DEFAULT[0]), F.lit(FORECAST_DEFAULT[1])
    for label, (level, answer) in FORECAST_ADVICE.items():
        priority = F.when(trend == label, level).otherwise(priority)
        text = F.when(trend == label, answer).otherwise(text)
    signal = F.concat(
        trend, F.lit(" | Expected Change: "), two_decimals(F.col("Expected_Change_Pct")),
        F.lit("% | Validation MAPE: "), two_decimals(F.col("Validation_MAPE")), F.lit("%"),
    )
    return _rows(summary.limit(1), "Forecast", priority, F.lit(FORECAST_ENTITY), signal, text, [F.asc("Model")])


def driver_rows(top_drivers: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """The largest driver of each product and issue, then the largest of those."""
    w = W.partitionBy("Product", "Issue").orderBy(F.desc("Complaint_Count"), F.asc("Sub-issue"))
    best = top_drivers.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    best = ranked(best, "Complaint_Count", "Product", "Issue").limit(p.recommended_drivers)
    return _rows(
        best, "Complaint Driver", F.lit("High"), F.concat("Product", F.lit(" → "), "Issue"),
        F.concat(F.lit("Complaints: "), F.col("Complaint_Count").cast("string")),
        F.concat(issue_advice(F.col("Issue")), F.lit(DRIVER_SUFFIX)),
        [F.desc("Complaint_Count"), F.asc("Product"), F.asc("Issue")],
    )


def all_rows(risk: DataFrame, drivers: DataFrame, product_growth: DataFrame, issue_growth: DataFrame,
             forecast: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    parts = [
        forecast_rows(forecast), risk_rows(risk, p), driver_rows(drivers, p),
        growth_rows(product_growth, "Product", "Product Growth", "Medium", p.recommended_products,
                    product_advice(F.col("Product"))),
        growth_rows(issue_growth, "Issue", "Issue Growth", "High", p.recommended_issues,
                    issue_advice(F.col("Issue"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def _rank(c: Column, order: Sequence[str]) -> Column:
    return F.array_position(F.array(*[F.lit(o) for o in order]), c)


def recommendations(rows: DataFrame) -> DataFrame:
    """Sorted by priority, then category, then the order within the category."""
    return rows.orderBy(_rank(F.col("Priority"), PRIORITIES), "Category", "_seq").select(*COLUMNS)


def action_plan(rows: DataFrame) -> DataFrame:
    """The first recommendation of each category, in the order of the plan."""
    w = W.partitionBy("Category").orderBy(_rank(F.col("Priority"), PRIORITIES), F.asc("_seq"))
    first = rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    first = first.filter(F.col("Category").isin(*ACTION_ORDER)).withColumn("_plan", F.lit(1))
    # At most one row per category is left.
    rank = F.row_number().over(W.partitionBy("_plan").orderBy(_rank(F.col("Category"), ACTION_ORDER)))
    return first.select(
        rank.alias("Action_Rank"), F.col("Category").alias("Focus_Area"), F.col("Entity").alias("Target"),
        F.col("Signal").alias("Why_It_Matters"), F.col("Recommendation").alias("Recommended_Action"),
    ).orderBy("Action_Rank")


def summary(recs: DataFrame) -> DataFrame:
    return recs.agg(
        F.count(F.lit(1)).alias("Total_Recommendations"),
        F.count_if(F.col("Priority") == "High").alias("High_Priority"),
        F.count_distinct("Category").alias("Categories"),
    )


def by_priority(recs: DataFrame, priorities: Sequence[str]) -> DataFrame:
    return recs.filter(F.col("Priority").isin(*priorities)).orderBy("Category", "Entity")


def executive_rollup(risk: DataFrame, drivers: DataFrame, product_growth: DataFrame, issue_growth: DataFrame,
                     forecast: DataFrame) -> DataFrame:
    """The head of each summary in one row; every part is a single-row scalar."""
    def head(df: DataFrame, order: Sequence[Column], columns: dict[str, str]) -> Column:
        fields = [F.col(c).alias(a) for c, a in columns.items()]
        return df.orderBy(*order).limit(1).select(F.struct(*fields)).scalar()

    parts = {
        "risk": (head(risk, [F.desc("Risk_Score"), F.asc("Company")],
                      {"Company": "Top_Risk_Company", "Risk_Score": "Top_Risk_Score"}),
                 ["Top_Risk_Company", "Top_Risk_Score"]),
        "driver": (head(drivers, [F.desc("Complaint_Count"), F.asc("Product"), F.asc("Issue"), F.asc("Sub-issue")],
                        {"Product": "Top_Driver_Product", "Issue": "Top_Driver_Issue",
                         "Complaint_Count": "Top_Driver_Complaints"}),
                   ["Top_Driver_Product", "Top_Driver_Issue", "Top_Driver_Complaints"]),
        "product": (head(product_growth, [F.desc("YoY_Growth_Pct"), F.asc("Product")],
                         {"Product": "Fastest_Product", "YoY_Growth_Pct": "Fastest_Product_Growth"}),
                    ["Fastest_Product", "Fastest_Product_Growth"]),
        "issue": (head(issue_growth, [F.desc("YoY_Growth_Pct"), F.asc("Issue")],
                       {"Issue": "Fastest_Issue", "YoY_Growth_Pct": "Fastest_Issue_Growth"}),
                  ["Fastest_Issue", "Fastest_Issue_Growth"]),
    }
    one = forecast.limit(1).select("Forecast_Trend", "Next_Month_Forecast", "Expected_Change_Pct")
    for name, (scalar, _) in parts.items():
        one = one.withColumn(f"_{name}", scalar)
    fields = [F.col(f"_{name}.{f}").alias(f) for name, (_, fs) in parts.items() for f in fs]
    return one.select(*fields, "Forecast_Trend", "Next_Month_Forecast", "Expected_Change_Pct")
