"""Confidence, review routing and extra candidates from class probabilities.

A row carries its probabilities as one array in class order. Everything here is computed inside the row with
array expressions: no row is exploded and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from casemill.functions.arrays import let
from casemill.params import DEFAULTS, Params

# Decisions and the note on extra candidates.
AUTO_ACCEPT, HUMAN_REVIEW = "AUTO_ACCEPT", "HUMAN_REVIEW"
MULTI_ISSUE_NOTE = (
    "Additional issues beyond the primary prediction are a heuristic derived from the probability distribution of a "
    "single-label classifier, not a validated multi-label model."
)


def canonical_scores(probability: Column, classes: Sequence[str], canonical: dict[str, str]) -> Column:
    """Probabilities summed per canonical label: ``array<struct<confidence, label>>``, best first, ties by
    label. ``canonical`` maps class labels; a class it lacks is its own label."""
    groups: dict[str, list[int]] = {}
    for i, label in enumerate(classes):
        groups.setdefault(canonical.get(label, label), []).append(i)

    def sums(p: Column) -> Column:
        return F.array(*[
            F.struct(
                reduce(lambda a, b: a + b, [F.get(p, F.lit(i)) for i in members]).alias("confidence"),
                F.lit(label).alias("label"),
            )
            for label, members in sorted(groups.items())
        ])

    return best_first(let(probability, sums))


def best_first(scores: Column) -> Column:
    """Scores in descending order; equal scores in ascending order of their labels."""
    keyed = F.transform(scores, lambda s: F.struct((-s["confidence"]).alias("k"), s["label"].alias("label")))
    return F.transform(
        F.array_sort(keyed), lambda s: F.struct((-s["k"]).alias("confidence"), s["label"].alias("label"))
    )


def raw_label(probability: Column, classes: Sequence[str]) -> Column:
    """The class with the largest probability, the first one in case of a tie."""
    names = F.array(*[F.lit(c) for c in classes])
    return let(probability, lambda q: F.get(names, F.array_position(q, F.array_max(q)).cast("int") - 1))


def _rounded(s: Column) -> Column:
    return F.struct(s["label"].alias("label"), F.bround(s["confidence"], 4).alias("confidence"))


def confidence_decision(scores: Column, raw: Column, p: Params = DEFAULTS) -> Column:
    """The prediction record of a row. The threshold looks at the confidence before it is rounded."""
    def record(s: Column) -> Column:
        top = F.get(s, F.lit(0))
        return F.struct(
            top["label"].alias("label"),
            F.bround(top["confidence"], 4).alias("confidence"),
            raw.alias("raw_label"),
            F.transform(F.slice(s, 2, p.alternatives), _rounded).alias("alternatives"),
            F.when(top["confidence"] >= p.confidence, AUTO_ACCEPT).otherwise(HUMAN_REVIEW).alias("decision"),
            F.lit(p.confidence).alias("confidence_threshold"),
        )

    return let(scores, record)


def candidate_issues(scores: Column, p: Params = DEFAULTS) -> Column:
    """Labels that come close to the best one: a heuristic, best label included, none for an empty array.
    When even the best score is not positive, only the best label, unrounded."""
    def record(s: Column, confidence: Column) -> Column:
        return F.struct(s["label"].alias("label"), confidence.alias("confidence"), F.lit(True).alias("is_heuristic"))

    def candidates(ranked: Column) -> Column:
        best = F.get(ranked, F.lit(0))["confidence"]
        close = F.filter(ranked, lambda s: F.try_divide(s["confidence"], best) >= p.multi_issue_ratio)
        many = F.transform(F.slice(close, 1, p.multi_issue_max), lambda s: record(s, F.bround(s["confidence"], 4)))
        single = F.transform(F.slice(ranked, 1, 1), lambda s: record(s, s["confidence"]))
        return F.when(best <= 0, single).otherwise(many)

    return let(scores, candidates)


def multi_issue_record(scores: Column, p: Params = DEFAULTS) -> Column:
    return let(candidate_issues(scores, p), lambda found: F.struct(
        F.get(found, F.lit(0)).alias("primary_issue"),
        F.slice(found, 2, p.multi_issue_max).alias("additional_candidate_issues"),
        F.lit(MULTI_ISSUE_NOTE).alias("note"),
    ))
