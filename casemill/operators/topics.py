"""Topic prevalence and emergence from per-document topic distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casemill.functions.arrays import let
from casemill.operators.counts import ranked
from casemill.params import DEFAULTS, Params


def dominant_topic(distribution: Column) -> Column:
    """Index of the largest weight, the first one in case of a tie."""
    return let(distribution, lambda d: (F.array_position(d, F.array_max(d)) - 1).cast("int"))


def document_topics(df: DataFrame, distribution: str, words: DataFrame | None = None) -> DataFrame:
    """Topic, weight and, if a topic table is given, the words of the topic."""
    d = F.col(distribution)
    out = df.withColumn("topic_id", dominant_topic(d)).withColumn("confidence", F.array_max(d)).drop(distribution)
    return out if words is None else out.join(words, "topic_id", "left")


def topic_ids(df: DataFrame, n: int) -> DataFrame:
    return df.sparkSession.range(n).select(F.col("id").cast("int").alias("topic_id"))


def prevalence(df: DataFrame, topic: str, n_topics: int) -> DataFrame:
    """Share of documents per topic, with 0 for topics without any. No documents give no rows."""
    counts = df.groupBy(F.col(topic).alias("topic_id")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    every = topic_ids(df, n_topics).join(counts, "topic_id", "left").withColumn("_total", total)
    share = F.coalesce(F.col("n"), F.lit(0)) / F.col("_total")
    return every.filter(F.col("_total") > 0).select("topic_id", share.alias("share"))


def emerging(current: DataFrame, baseline: DataFrame, min_growth: float = DEFAULTS.emerging_growth) -> DataFrame:
    """Topics whose share grew by at least ``min_growth``, tested before rounding."""
    now = current.select("topic_id", F.col("share").alias("c"))
    then = baseline.select("topic_id", F.col("share").alias("b"))
    both = now.join(then, "topic_id", "full_outer").select(
        "topic_id", F.coalesce("c", F.lit(0.0)).alias("c"), F.coalesce("b", F.lit(0.0)).alias("b")
    )
    grown = both.filter(F.col("c") - F.col("b") >= min_growth).select(
        "topic_id",
        F.bround("c", 4).alias("current_share"),
        F.bround("b", 4).alias("baseline_share"),
        F.bround(F.col("c") - F.col("b"), 4).alias("absolute_growth"),
    )
    return ranked(grown, "absolute_growth", "topic_id")


def with_labels(topics: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Adds the label of a table ``(topic_id, label)``, which belongs to one fitted model; else 'Topic n'."""
    fallback = F.concat(F.lit("Topic "), F.col("topic_id").cast("string"))
    if labels is None:
        return topics.withColumn("label", fallback)
    return topics.join(labels, "topic_id", "left").withColumn("label", F.coalesce("label", fallback))


def discovery_report(
    words: DataFrame, current: DataFrame | None = None, baseline: DataFrame | None = None,
    labels: DataFrame | None = None, p: Params = DEFAULTS,
) -> dict[str, DataFrame]:
    """The topic catalog, and where prevalence is known the recurring themes and the emerging ones."""
    report = {"topics": with_labels(words, labels).orderBy("topic_id")}
    if current is not None:
        themes = with_labels(current.select("topic_id", F.bround("share", 4).alias("share")), labels)
        report["recurring_themes"] = ranked(themes, "share", "topic_id")
        if baseline is not None:
            report["emerging_issues"] = with_labels(emerging(current, baseline, p.emerging_growth), labels)
    return report
