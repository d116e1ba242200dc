"""Word and phrase frequencies over whole narratives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from casemill.functions import text
from casemill.operators.counts import ranked
from casemill.params import DEFAULTS


def _count(words: DataFrame, out: str, k: int | None) -> DataFrame:
    result = ranked(words.groupBy(out).agg(F.count(F.lit(1)).alias("Count")), "Count", out)
    return result if k is None else result.limit(k)


def top_words(
    df: DataFrame, column: str, k: int | None = DEFAULTS.top_words, stop_words: Sequence[str] = text.STOP_WORDS,
) -> DataFrame:
    """Most frequent words of raw text: three ASCII letters or more, stop words out. All rows are counted."""
    words = text.drop_stop_words(text.ascii_words(F.col(f"`{column}`")), stop_words)
    return _count(df.select(F.explode(words).alias("Word")), "Word", k)


def top_ngrams(
    df: DataFrame, column: str, n: int, k: int | None = 20, stop_words: Sequence[str] = text.STOP_WORDS,
) -> DataFrame:
    """Most frequent n-grams of cleaned text; stop words go before the n-grams are formed."""
    words = text.drop_stop_words(text.tokens(text.clean_text(F.col(f"`{column}`"))), stop_words)
    staged = df.select(words.alias("w"))
    return _count(staged.select(F.explode(text.ngrams(F.col("w"), n)).alias("Phrase")), "Phrase", k)


def with_clean_text(df: DataFrame, column: str, drop_empty: bool = False) -> DataFrame:
    out = df.withColumn("clean_text", text.clean_text(F.col(f"`{column}`")))
    return out.filter(F.length("clean_text") > 0) if drop_empty else out
