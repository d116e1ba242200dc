"""Counts, shares, trends and cross-tables.

Ties are always broken the same way: larger count first, then keys in ascending order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from casemill.functions import labels
from casemill.operators.facts import SET_ID, CubeFacts, Facts, as_facts, grouped_sets, set_id
from casemill.params import DEFAULTS, Params
from casemill.session import stage

Source = DataFrame | Facts


def present(df: DataFrame, *keys: str) -> DataFrame:
    return df.filter(_all_present(keys))


def _all_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def ranked(df: DataFrame, by: str, *keys: str) -> DataFrame:
    return df.orderBy(F.desc(by), *[F.asc(k) for k in keys])


def value_counts(
    source: Source, key: str, out: str | None = None, count: str = "Count", k: int | None = None,
    nulls: bool = False,
) -> DataFrame:
    """Rows per value, largest first; the first ``k`` only if asked for. Null values drop out unless kept."""
    out = out or key
    counts = as_facts(source).by(key)
    counts = counts if nulls else present(counts, key)
    result = ranked(counts.select(F.col(key).alias(out), F.col("rows").alias(count)), count, out)
    return result if k is None else result.limit(k)


def shares(
    source: Source, key: str, out: str | None = None, share: str = "Share_Pct", k: int | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Percent of all rows that have a value; the cut to ``k`` rows comes after the division."""
    counts = value_counts(source, key, out)
    out = out or key
    pct = F.col("Count") / counts.agg(F.sum("Count")).scalar() * 100
    pct = pct if digits is None else F.bround(pct, digits)
    result = counts.select(out, pct.alias(share), "Count")
    result = ranked(result, "Count", out).select(out, share)
    return result if k is None else result.limit(k)


def cross_counts(
    source: Source, keys: Sequence[str], count: str = "Count", top: dict[str, int] | None = None,
) -> DataFrame:
    """Rows per combination of keys; ``top`` keeps only the k most frequent values of a key.

    The most frequent values come from the same grouped table, as an array of k values, so the rows are read
    and shuffled once. That table still holds combinations with a null, which count for the frequency of their
    other key; testing the count instead of the keys keeps the test above the aggregation, where all share it.
    """
    grouped = as_facts(source).by(*keys).select(*keys, "rows")
    if not top:
        return present(grouped, *keys).withColumnRenamed("rows", count)
    wanted = _all_present(keys)
    for key, k in top.items():
        wanted = wanted & F.array_contains(_most_frequent(grouped, key, k), F.col(key))
    return grouped.select(*keys, F.when(wanted, F.col("rows")).alias(count)).filter(F.col(count).isNotNull())


def _most_frequent(grouped: DataFrame, key: str, k: int) -> Column:
    """Scalar array of the ``k`` most frequent values of ``key``."""
    totals = grouped.groupBy(key).agg(F.sum("rows").alias("_rows"))
    known = totals.withColumn("_rows", F.when(F.col(key).isNotNull(), F.col("_rows"))).filter(F.col("_rows").isNotNull())
    return ranked(known, "_rows", key).limit(k).agg(F.collect_list(key)).scalar()


def yearly_trend(source: Source, count: str = "Complaints") -> DataFrame:
    return cross_counts(source, ["Year"], count).orderBy("Year")


def trend_by(source: Source, key: str, k: int | None = None, count: str = "Complaints") -> DataFrame:
    """Rows per year and key, for all keys or for the ``k`` most frequent ones."""
    rows = cross_counts(source, ["Year", key], count, {key: k} if k else None)
    return rows.orderBy(F.asc("Year"), F.desc(count), F.asc(key))


def pivot_counts(
    source: Source, index: str, column: str, values: Sequence | None = None, top: dict[str, int] | None = None,
) -> DataFrame:
    """Wide cross-table, 0 where a combination does not occur. The columns should be few; when they are not
    given, the counts are stored first, since Spark then looks them up in a job of its own."""
    rows = cross_counts(source, [index, column], "Count", top)
    rows = stage(rows, "cross-table") if values is None else rows
    return rows.groupBy(index).pivot(column, values).agg(F.sum("Count")).na.fill(0).orderBy(index)


def dominant_partner(source: Source, key: str, partner: str, name: str, count: str) -> DataFrame:
    """The most frequent ``partner`` per ``key`` (ties: lowest), from counts and never from a wide table."""
    w = W.partitionBy(key).orderBy(F.desc("rows"), F.asc(partner))
    return ranked(
        present(as_facts(source).by(key, partner), key, partner)
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .select(key, F.col(partner).alias(name), F.col("rows").alias(count)),
        count, key,
    )


def name_match_summary(source: Source, pattern: str, k: int = 10) -> DataFrame:
    """Rows and timely percent of the companies whose name matches, case-insensitive; rows without an
    answer on timeliness do not count."""
    rows = as_facts(source).by("Company").filter(F.col("Company").rlike(f"(?i){pattern}"))
    rows = rows.filter(F.col("timely_known") > 0).select(
        "Company",
        F.col("timely_known").alias("Total_Complaints"),
        (F.col("timely_yes") / F.col("timely_known") * 100).alias("Timely_Response_Pct"),
    )
    return ranked(rows, "Total_Complaints", "Company").limit(k)


def mode_value(source: Source, key: str, default: str = "Not Available", out: str = "Value") -> DataFrame:
    """Most frequent value as one row; the default when there is none."""
    counts = present(as_facts(source).by(key), key)
    return counts.agg(F.coalesce(_top_value(F.lit(True), key), F.lit(default)).alias(out))


def _top_value(where: Column, key: str) -> Column:
    order = F.struct(-F.col("rows"), F.col(key))
    return F.min_by(F.when(where, F.col(key)), F.when(where, order))


def kpis(source: Source) -> DataFrame:
    """Key figures in one row. Over rows: one scan with grouping sets; distinct counts, modes and the peak
    year then come from the grouped table, so no task holds all distinct values."""
    singles = ("Company", "Product", "State", "Issue", "Submitted via", "Year")
    if isinstance(source, CubeFacts):
        facts = source
    else:
        sets = [(), *[(k,) for k in singles]]
        facts = CubeFacts(grouped_sets(as_facts(source).df, sets))

    def is_set(*keys: str) -> Column:
        return F.col(SET_ID) == set_id(keys, facts.keys)

    def of(key: str) -> Column:
        return is_set(key) & F.col(key).isNotNull()

    def total(measure: str) -> Column:
        return F.sum(F.when(is_set(), F.col(measure)))

    def top(key: str) -> Column:
        return F.coalesce(_top_value(of(key), key), F.lit("Not Available"))

    def pct(part: str, whole: str) -> Column:
        return F.try_divide(total(part), total(whole)) * 100

    return facts.df.agg(
        total("rows").alias("total_complaints"),
        F.count_if(of("Company")).alias("total_companies"),
        F.count_if(of("Product")).alias("total_products"),
        F.count_if(of("State")).alias("total_states"),
        pct("timely_yes", "timely_known").alias("timely_response_pct"),
        F.try_divide(total("delay_sum"), total("delay_known")).alias("avg_resolution_delay"),
        pct("narrative_rows", "narrative_known").alias("narrative_availability_pct"),
        top("Product").alias("top_product"),
        top("Company").alias("top_company"),
        top("Issue").alias("top_issue"),
        top("Submitted via").alias("top_channel"),
        _top_value(of("Year"), "Year").alias("peak_year"),
        F.max(F.when(of("Year"), F.col("rows"))).alias("peak_year_complaints"),
    )


# Narrative summaries -------------------------------------------------------------------------------


def narrative_length_trend(source: Source) -> DataFrame:
    return _mean_words(source, "Year").orderBy("Year")


def narrative_length_by(source: Source, key: str, k: int | None = None) -> DataFrame:
    result = ranked(_mean_words(source, key), "Avg_Word_Count", key)
    return result if k is None else result.limit(k)


def _mean_words(source: Source, key: str) -> DataFrame:
    rows = present(as_facts(source).by(key), key).filter(F.col("words_known") > 0)
    return rows.select(key, (F.col("words_sum") / F.col("words_known")).alias("Avg_Word_Count"))


def narrative_availability_by(source: Source, key: str, k: int | None = None) -> DataFrame:
    rows = present(as_facts(source).by(key), key).select(
        key, (F.col("narrative_rows") / F.col("narrative_known") * 100).alias("Narrative_Availability_Pct")
    )
    result = ranked(rows, "Narrative_Availability_Pct", key)
    return result if k is None else result.limit(k)


def narrative_complexity(df: DataFrame) -> DataFrame:
    """Rows with a narrative per word-count bucket."""
    rows = df.filter((F.col("Has_Narrative") == 1) & F.col("Narrative_Word_Count").isNotNull())
    bucket = labels.complexity(F.col("Narrative_Word_Count"))
    return value_counts(rows.select(bucket.alias("Complexity")), "Complexity")


def narrative_word_counts(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    words = F.col("Narrative_Word_Count")
    return df.select(words).filter(words <= p.max_words)


def delay_distribution(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    delay = F.col("Resolution_Delay")
    return df.select(delay).filter(delay.between(0, p.max_delay_days))


# Displays over summary tables ----------------------------------------------------------------------


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over an integer column. Rows are first counted per value, so the bounds and the
    bins come from the small table of values."""
    values = present(df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")), column)
    bounds = values.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high"))).scalar()
    v, low, high = F.col(column).cast("double"), F.col("_b.low").cast("double"), F.col("_b.high").cast("double")
    raw = F.floor((v - low) * bins / (high - low)).cast("int") + 1
    bin_no = F.when(high > low, F.least(raw, F.lit(bins))).otherwise(F.lit(1))
    return (
        values.withColumn("_b", bounds)
        .groupBy(bin_no.alias("Bin"))
        .agg(F.sum("rows").alias("Count"), F.min(column).alias("Low"), F.max(column).alias("High"))
        .orderBy("Bin")
    )


def rollup_counts(source: Source, keys: Sequence[str], count: str = "Complaints") -> DataFrame:
    """Sub-totals of a hierarchy: all keys, then without the last one, and so on to the grand total."""
    rows = present(as_facts(source).by(*keys), *keys)
    return rows.rollup(*keys).agg(F.sum("rows").alias(count), F.grouping_id().alias("Level"))


def last_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows of a series, in ascending order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n).orderBy(*order)


def first_per_order(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
