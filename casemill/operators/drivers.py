"""Which product, issue and sub-issue combinations cause the volume."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from casemill.operators.counts import Source, present, ranked
from casemill.operators.facts import as_facts
from casemill.params import DEFAULTS, Params

KEYS = ("Product", "Issue", "Sub-issue")


def _groups(source: Source) -> tuple[DataFrame, DataFrame]:
    """Rows per combination, and the product totals summed from them: both from one shuffle of the rows."""
    facts = as_facts(source).filled(**{"Sub-issue": "Unknown"})
    groups = present(facts.by(*KEYS), "Product", "Issue").select(*KEYS, F.col("rows").alias("Complaint_Count"))
    return groups, groups.groupBy("Product").agg(F.sum("Complaint_Count").alias("Product_Total_Complaints"))


def _shares(groups: DataFrame, totals: DataFrame) -> DataFrame:
    share = F.col("Complaint_Count") / F.col("Product_Total_Complaints") * 100
    return groups.join(totals, "Product").select(
        *KEYS, "Complaint_Count", "Product_Total_Complaints", share.alias("Driver_Contribution_Pct")
    )


def all_drivers(source: Source) -> DataFrame:
    """Rows per combination with the product total and the share in it.

    The totals are joined back. A window per product would put all combinations of a hot product into one
    task; a join side this small is broadcast or split instead.
    """
    return _shares(*_groups(source))


def drivers_of_top_products(source: Source, p: Params = DEFAULTS) -> DataFrame:
    """All combinations of the largest products: joining the few largest totals keeps their rows only."""
    groups, totals = _groups(source)
    largest = ranked(totals, "Product_Total_Complaints", "Product").limit(p.driver_products)
    return ranked(_shares(groups, F.broadcast(largest)), "Complaint_Count", *KEYS)


def top_drivers(drivers: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    return ranked(drivers, "Complaint_Count", *KEYS).limit(p.top_drivers)


def top_drivers_per_product(drivers: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """The first rows of each product; every task cuts to that many rows per product before the shuffle."""
    w = W.partitionBy("Product").orderBy(F.desc("Complaint_Count"), F.asc("Issue"), F.asc("Sub-issue"))
    rows = drivers.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= p.drivers_per_product)
    return rows.drop("_rn").orderBy(F.asc("Product"), F.desc("Complaint_Count"), "Issue", "Sub-issue")
