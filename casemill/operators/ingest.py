"""Raw complaint text to the processed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from casemill.functions import dates, text
from casemill.sources.complaints import NARRATIVE, ROW_ORDER, require_columns

# What a missing field means.
FILL_VALUES = {
    "Tags": "Normal Consumer",
    "Sub-product": "Unknown",
    "Sub-issue": "Unknown",
    "State": "Unknown",
    "Company public response": "No public response",
    "Company response to consumer": "Unknown",
    "Issue": "Unknown",
    "ZIP code": "Unknown",
}
# Tags with another name as a consumer group; every other tag keeps its own.
GROUP_NAMES = {"Older American, Servicemember": "Older American + Servicemember"}
DATE_COLUMNS = ("Date received", "Date sent to company")


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]


def clean_text_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({c: text.strip(F.col(f"`{c}`")) for c in _string_columns(df)})


def null_na_tokens(df: DataFrame) -> DataFrame:
    return df.withColumns({c: text.null_tokens(F.col(f"`{c}`")) for c in _string_columns(df)})


def fill_missing(df: DataFrame, values: dict[str, str] = FILL_VALUES) -> DataFrame:
    return df.na.fill({c: v for c, v in values.items() if c in df.columns})


def parse_dates(df: DataFrame, columns: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    return df.withColumns({c: dates.parse_timestamp(F.col(f"`{c}`")) for c in columns})


def add_features(df: DataFrame) -> DataFrame:
    received, sent, narrative = F.col("Date received"), F.col("Date sent to company"), F.col(NARRATIVE)
    return df.withColumns(
        {
            **dates.calendar_parts(received),
            "Resolution_Delay": dates.whole_days_between(received, sent),
            "Has_Narrative": narrative.isNotNull().cast("int"),
            "Narrative_Length": text.char_count(narrative),
            "Narrative_Word_Count": text.word_count(narrative),
        }
    )


def consumer_group(tags: Column) -> Column:
    group = tags
    for tag, name in GROUP_NAMES.items():
        group = F.when(tags == tag, name).otherwise(group)
    return group


def replace_values(c: Column, mapping: dict[str, str]) -> Column:
    """Exact-value replacement; other values pass through."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[c], c)


def preprocess(df: DataFrame) -> DataFrame:
    """Null tokens, strip, fill, parse, derive, group: a projection without any shuffle."""
    require_columns(df)
    df = fill_missing(clean_text_columns(null_na_tokens(df)))
    df = add_features(parse_dates(df))
    return df.withColumn("Consumer_Group", consumer_group(F.col("Tags")))


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key. Spark cuts every task to its own first row per key before the shuffle,
    so a key that holds a large part of the rows sends one row per task."""
    w = W.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def ingest(raw: DataFrame) -> DataFrame:
    """Processed table of a raw scan (``sources.complaints.read_raw_csv``): one shuffle, on the id."""
    return dedupe_first(preprocess(raw), ["Complaint ID"], [F.col(ROW_ORDER)]).drop(ROW_ORDER)
