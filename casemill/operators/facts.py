"""Grouped measures of the complaint table, from its rows or from one shared cube.

Every summary starts from ``facts.by(keys)``: one row per key combination with additive measures. Over
rows this is one partial-then-final aggregation (Catalyst drops the measures nobody reads). Over a cube it
is a filter on a small table, so that a full run reads the complaint table once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casemill.session import stage

SET_ID = "_set"


def _additive(columns: Sequence[str]) -> dict[str, Column]:
    """The measures that the given columns allow."""
    have = set(columns)
    measures = {"rows": F.count(F.lit(1))}
    if "Timely response?" in have:
        timely = F.col("Timely response?")
        measures["timely_known"] = F.count(timely)
        measures["timely_yes"] = F.count_if(timely == "Yes")
        measures["timely_no"] = F.count_if(timely == "No")
    if "Resolution_Delay" in have:
        measures["delay_known"] = F.count("Resolution_Delay")
        measures["delay_sum"] = F.sum(F.col("Resolution_Delay").cast("long"))
    if "Has_Narrative" in have:
        measures["narrative_known"] = F.count("Has_Narrative")
        measures["narrative_rows"] = F.sum(F.col("Has_Narrative").cast("long"))
        words = F.when(F.col("Has_Narrative") == 1, words_of(columns))
        measures["words_known"] = F.count(words)
        measures["words_sum"] = F.sum(words.cast("long"))
    return measures


def words_of(columns: Sequence[str]) -> Column:
    """Word count, else the text length, else null."""
    for name in ("Narrative_Word_Count", "Narrative_Length"):
        if name in columns:
            return F.col(name)
    return F.lit(None).cast("int")


class Facts:
    def __init__(self, df: DataFrame, fills: dict[str, str] | None = None):
        self.df = df
        self.fills = fills or {}

    def by(self, *keys: str) -> DataFrame:
        df = self.df.na.fill(self.fills) if self.fills else self.df
        measures = [m.alias(n) for n, m in _additive(df.columns).items()]
        return df.groupBy(*keys).agg(*measures)

    def filled(self, **values: str) -> Facts:
        return type(self)(self.df, {**self.fills, **values})


class CubeFacts(Facts):
    def __init__(self, df: DataFrame, fills: dict[str, str] | None = None):
        super().__init__(df, fills)
        self.keys = [c for c in df.columns if c in CUBE_KEYS]
        self.measures = [c for c in df.columns if c not in CUBE_KEYS and c != SET_ID]

    def by(self, *keys: str) -> DataFrame:
        part = self.df.filter(F.col(SET_ID) == set_id(keys, self.keys)).select(*keys, *self.measures)
        if not any(k in self.fills for k in keys):
            return part
        return part.na.fill(self.fills).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in self.measures])


def as_facts(source: DataFrame | Facts) -> Facts:
    return source if isinstance(source, Facts) else Facts(source)


CUBE_KEYS = (
    "Year", "Month", "Product", "Issue", "Sub-issue", "Company", "State", "Submitted via",
    "Consumer_Group", "Timely response?", "Company response to consumer", "Has_Narrative",
)
CUBE_SETS = (
    (), ("Year",), ("Year", "Month"), ("Product",), ("Year", "Product"), ("Issue",), ("Year", "Issue"),
    ("Issue", "Product"), ("Sub-issue",), ("Product", "Issue", "Sub-issue"), ("Company",),
    ("Company", "Timely response?"), ("Company", "Company response to consumer"), ("State",),
    ("Submitted via",), ("Consumer_Group",), ("Timely response?",), ("Company response to consumer",),
    ("Year", "Company response to consumer"), ("Has_Narrative",),
)


def set_id(keys: Sequence[str], all_keys: Sequence[str]) -> int:
    """``grouping_id`` of the set: one bit per key, 1 where the key is not grouped by."""
    bits = "".join("0" if k in keys else "1" for k in all_keys)
    return int(bits, 2)


def grouped_sets(df: DataFrame, sets: Sequence[Sequence[str]] = CUBE_SETS) -> DataFrame:
    keys = [k for k in CUBE_KEYS if any(k in s for s in sets)]
    measures = [m.alias(n) for n, m in _additive(df.columns).items()]
    return df.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias(SET_ID), *measures
    )


def cube(df: DataFrame, sets: Sequence[Sequence[str]] = CUBE_SETS) -> CubeFacts:
    """All key sets in one scan and one shuffle, written once to the shared folder."""
    return CubeFacts(stage(grouped_sets(df, sets), "cube"))
