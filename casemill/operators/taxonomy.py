"""Canonical labels for product and issue names that were renamed over the years."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casemill.functions.text import strip
from casemill.operators.counts import Source, value_counts
from casemill.params import DEFAULTS, Params

# Fixed values: (canonical label, raw labels, confidence, rationale).
PRODUCT_GROUPS = (
    ("Credit Reporting",
     ("Credit reporting",
      "Credit reporting, credit repair services, or other personal consumer reports",
      "Credit reporting or other personal consumer reports"),
     "high", "Renamed twice; the population of complaints stayed the same."),
    ("Credit Card / Prepaid Card",
     ("Credit card", "Prepaid card", "Credit card or prepaid card"),
     "high", "Two products merged into one from 2018."),
    ("Payday / Title / Personal Loan",
     ("Payday loan",
      "Payday loan, title loan, or personal loan",
      "Payday loan, title loan, personal loan, or advance loan"),
     "high", "The label was widened step by step; the category stayed the same."),
    ("Checking / Savings Account",
     ("Bank account or service", "Checking or savings account"),
     "high", "Renamed in the 2017 revision."),
    ("Consumer Loan (Legacy)",
     ("Consumer Loan",),
     "medium", "Retired around 2017 and spread over several products; kept as a category of its own."),
)
ISSUE_GROUPS = (
    ("Incorrect Information on Report",
     ("Incorrect information on credit report", "Incorrect information on your report"),
     "high", "Wording updated in the 2017 revision."),
    ("Company Investigation Problem",
     ("Problem with a company's investigation into an existing issue",
      "Problem with a company's investigation into an existing problem",
      "Problem with a credit reporting company's investigation into an existing problem",
      "Credit reporting company's investigation"),
     "high", "All four describe a dispute over how a company investigated an earlier complaint."),
    ("Debt Collection Attempts on Debt Not Owed",
     ("Attempts to collect debt not owed", "Cont'd attempts collect debt not owed"),
     "high", "An abbreviation was spelled out."),
    ("Closing an Account",
     ("Closing an account", "Closing your account"),
     "high", "Only the article changed."),
    ("Dealing with Lender or Servicer",
     ("Dealing with my lender or servicer", "Dealing with your lender or servicer"),
     "high", "Only the pronoun changed."),
    ("Unable to Get Credit Report or Score",
     ("Unable to get credit report/credit score", "Unable to get your credit report or credit score"),
     "high", "Punctuation and wording."),
    ("Trouble Using the Card",
     ("Trouble using the card", "Trouble using your card"),
     "high", "Only the article changed."),
    ("Funds Being Low Caused a Problem",
     ("Problem caused by your funds being low", "Problems caused by my funds being low"),
     "high", "Number and pronoun."),
    ("Struggling to Repay Loan",
     ("Struggling to pay your loan", "Struggling to repay your loan"),
     "high", "Pay became repay."),
    ("Getting a Loan or Lease",
     ("Getting a loan or lease", "Getting the loan"),
     "medium", "Probably the same intake issue; to be confirmed on the data."),
)
TAXONOMIES = {"Product": PRODUCT_GROUPS, "Issue": ISSUE_GROUPS}


def raw_labels(field: str) -> list[str]:
    return [raw for _, raws, _, _ in TAXONOMIES[field] for raw in raws]


def canonical(c: Column, field: str) -> Column:
    """The canonical label; unknown labels are their own, null stays null. A map literal of at most two
    dozen entries, so no join is needed."""
    pairs = [F.lit(x) for name, raws, _, _ in TAXONOMIES[field] for raw in raws for x in (raw, name)]
    label = strip(c)
    return F.coalesce(F.create_map(*pairs)[label], label)


def canonical_product(c: Column) -> Column:
    return canonical(c, "Product")


def canonical_issue(c: Column) -> Column:
    return canonical(c, "Issue")


def dimension(spark: SparkSession, field: str) -> DataFrame:
    """One row per raw label."""
    rows = [(field, raw, name, conf, why) for name, raws, conf, why in TAXONOMIES[field] for raw in raws]
    return spark.createDataFrame(rows, "field string, raw_label string, canonical string, confidence string, "
                                       "rationale string")


BROADCAST_LABELS = 100_000


def canonicalize_by(df: DataFrame, column: str, labels: DataFrame, out: str = "canonical") -> DataFrame:
    """As ``canonical``, with the labels of any table ``(raw_label, canonical)``. A small table, by count, goes to the
    tasks; rows of a hot label are only shuffled for a larger one."""
    key = labels.select(F.col("raw_label").alias("_raw"), F.col("canonical").alias("_canonical"))
    if key.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        key = F.broadcast(key)
    joined = df.withColumn("_label", strip(F.col(f"`{column}`"))).join(key, F.col("_label") == F.col("_raw"), "left")
    return joined.withColumn(out, F.coalesce("_canonical", "_label")).drop("_label", "_raw", "_canonical")


def canonical_counts(source: Source, column: str, labels: DataFrame, out: str, n: str = "Count") -> DataFrame:
    """Rows per canonical label: counted per raw label first, so that only the counts meet the labels."""
    raw = value_counts(source, column, "label", n)
    named = canonicalize_by(raw, "label", labels, out)
    return named.groupBy(out).agg(F.sum(n).alias(n)).orderBy(F.desc(n), out)


def report(spark: SparkSession, field: str) -> DataFrame:
    """One row per canonical label with the raw labels behind it."""
    return dimension(spark, field).groupBy(F.col("canonical").alias("canonical_label")).agg(
        F.array_sort(F.collect_list("raw_label")).alias("raw_labels"),
        F.count(F.lit(1)).alias("raw_label_count"),
        F.first("confidence").alias("confidence"),
        F.first("rationale").alias("rationale"),
    )


def label_support(source: Source, column: str) -> DataFrame:
    """Rows per raw label, nulls left out."""
    return value_counts(source, column, "label", "support")


def merged_groups(support: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    """Canonical labels that more than one raw label maps to, with members and combined support. The
    members are the distinct labels of one canonical label, so the arrays are as short as the taxonomy."""
    groups = support.groupBy(fn(F.col("label")).alias("canonical_label")).agg(
        F.array_sort(F.collect_list(F.struct("label", "support"))).alias("raw_components"),
        F.sum("support").alias("combined_support"),
        F.count(F.lit(1)).alias("raw_label_count"),
    )
    return groups.filter(F.col("raw_label_count") > 1)


def audit(support: DataFrame, fn: Callable[[Column], Column], p: Params = DEFAULTS) -> DataFrame:
    """Class counts before and after, as one row, from a table ``(label, support)``."""
    groups = support.groupBy(fn(F.col("label")).alias("c")).agg(
        F.sum("support").alias("support"), F.count(F.lit(1)).alias("raw"),
        F.count_if(F.col("support") < p.rare_support).alias("raw_rare"),
    )
    return groups.agg(
        F.coalesce(F.sum("raw"), F.lit(0)).alias("raw_class_count"),
        F.count(F.lit(1)).alias("canonical_class_count"),
        (F.coalesce(F.sum("raw"), F.lit(0)) - F.count(F.lit(1))).alias("classes_removed"),
        F.coalesce(F.sum("raw_rare"), F.lit(0)).alias("rare_classes_before"),
        F.count_if(F.col("support") < p.rare_support).alias("rare_classes_after"),
        F.count_if(F.col("raw") > 1).alias("merged_groups"),
    )
