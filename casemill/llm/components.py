"""Connected components of a link table, in Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casemill.session import stage


def components(links: DataFrame, name: str) -> DataFrame:
    """``id, component``: the smallest id reachable, for every id in ``links(a, b)``.

    Each round takes the smallest label among the neighbours and then follows the label's own label, so a chain of
    n links needs about log n rounds. Every round is a written table: nothing is recomputed after a lost executor.
    The labels of a node with very many neighbours are combined before the shuffle.
    """
    both = stage(
        links.select("a", "b").where("a <> b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b"))
        .distinct(), f"{name}-links")
    labels = stage(both.groupBy(F.col("a").alias("id")).agg(F.least("a", F.min("b")).alias("component")), f"{name}-round")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(
            F.min("component").alias("near"))
        step = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("mid"))
        of = labels.select(F.col("id").alias("mid"), F.col("component").alias("far"))
        step = stage(step.join(of, "mid").select("id", "old", F.least("mid", "far").alias("component")), f"{name}-round")
        changed = step.where("component <> old").limit(1).count()
        labels = step.select("id", "component")
        if not changed:
            return labels
