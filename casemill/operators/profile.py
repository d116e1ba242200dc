"""Column and table profiles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from casemill.session import stage


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and percent per column: one pass, whatever the number of columns."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    )
    long = counts.unpivot(["_rows"], df.columns, "Column", "Missing_Count")
    pct = F.bround(F.try_divide(F.col("Missing_Count"), F.col("_rows")) * 100, 2)
    return long.select("Column", "Missing_Count", pct.alias("Missing_Percentage")).orderBy(
        F.desc("Missing_Percentage"), "Column"
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier row. Rows are grouped by a 256-bit digest, so long texts stay where
    they are and only digests travel."""
    digest = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), 256)
    groups = df.groupBy(digest.alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("Rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("Duplicate_Rows"),
    )


BUCKETS = 1024


def _buckets(kind: T.DataType, low: Any, high: Any) -> Column:
    """Number of the part of [low, high] that ``v`` lies in, not falling with v; low is in the first and high in another part."""
    v = F.col("v")
    if isinstance(kind, T.DoubleType):
        width = high / 2 - low / 2  # halves, as the whole range may be beyond a double
        if not width:
            return F.when(v == low, 0).otherwise(1).cast("bigint")
        return F.least(F.floor((v / 2 - low / 2) / width * BUCKETS), F.lit(BUCKETS - 1)).cast("bigint")
    scale = 10 ** (kind.scale if isinstance(kind, T.DecimalType) else 0)
    whole = (v.cast("decimal(20,0)") if scale == 1 and not isinstance(kind, T.DecimalType) else v * F.lit(Decimal(scale))).cast("decimal(38,0)")
    low, high = int(low * scale), int(high * scale)
    return F.call_function("div", (whole - F.lit(Decimal(low))) * BUCKETS, F.lit(Decimal(high - low + 1))).cast("bigint")


def order_statistics(values: DataFrame, ranks: Sequence[int], low: Any, high: Any) -> dict[int, Any]:
    """The values at the given ranks (from 0) of a stored column ``v`` of finite numbers between ``low`` and ``high``.

    Each step counts the rows of a range in ``BUCKETS`` parts and goes on with the parts that hold a rank, between their
    own least and greatest value. A part with a single value, or a rank at its edge, is settled. A task sends a row a
    part, so no step holds the distinct values anywhere; a thousandth of the rows is left after each.
    """
    kind = values.schema["v"].dataType
    found: dict[int, Any] = {}
    open_ = [(low, high, 0, sorted(set(ranks)))] if ranks else []
    while open_:
        part = F.lit(None).cast("int")
        bucket = F.lit(None).cast("bigint")
        for i, (a, b, _, _) in enumerate(open_):
            inside = (F.col("v") >= F.lit(a)) & (F.col("v") <= F.lit(b))
            part = F.when(inside, i).otherwise(part)
            bucket = F.when(inside, _buckets(kind, a, b)).otherwise(bucket)
        rows = values.select("v", part.alias("part"), bucket.alias("bucket")).where("part is not null")
        counts = rows.groupBy("part", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("a"), F.max("v").alias("b"))
        before = [x[2] for x in open_]
        next_ = []
        for i, _, n, a, b in sorted(tuple(r) for r in counts.collect()):
            first, last = before[i], before[i] + n - 1
            before[i] += n
            rest = []
            for r in (r for r in open_[i][3] if first <= r <= last):
                if a == b or r in (first, last):
                    found[r] = b if r == last else a
                else:
                    rest.append(r)
            if rest:
                next_.append((a, b, first, rest))
        open_ = next_
    return found


def quantiles(values: DataFrame, shares: Sequence[float], count: int, low: Any, high: Any, minus: int = 0, plus: int = 0) -> list[float | None]:
    """Exact quantiles, interpolated between neighbours. ``minus`` and ``plus`` rows are infinite; ``low`` and ``high``
    bound the others."""
    if not count:
        return [None] * len(shares)
    places = [(count - 1) * s for s in shares]
    ends = [(math.floor(x), math.ceil(x)) for x in places]
    at = {r for pair in ends for r in pair}
    inner = [r - minus for r in at if minus <= r < count - plus]
    known = order_statistics(values, inner, low, high)
    value = {r: -math.inf if r < minus else math.inf if r >= count - plus else float(known[r - minus]) for r in at}
    return [value[a] if a == b or value[a] == value[b] else value[a] + (value[b] - value[a]) * (x - a) for x, (a, b) in zip(places, ends)]


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum of a number column. Null and NaN do not count;
    decimals of more than 27 digits are taken as doubles. The column alone is stored and then read a few times."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.FloatType) or (isinstance(kind, T.DecimalType) and kind.precision > 27):
        kind = T.DoubleType()
    values = df.select(F.col(f"`{column}`").cast(kind).alias("v")).where("v is not null")
    if isinstance(kind, T.DoubleType):
        values = values.where(~F.isnan("v"))
    values = stage(values, "profile-values")
    v, x = F.col("v"), F.col("v").cast("double")
    finite = F.abs(x) < math.inf
    total = F.sum(x) if isinstance(kind, T.DoubleType) else F.sum(v.cast("decimal(38,%d)" % (kind.scale if isinstance(kind, T.DecimalType) else 0))).cast("double")
    n, s, least, most, low, high, minus, plus = values.agg(
        F.count(F.lit(1)), total, F.min(v), F.max(v), F.min(F.when(finite, v)), F.max(F.when(finite, v)),
        F.count_if(x == -math.inf), F.count_if(x == math.inf)).first()
    mean = s / n if n else None
    spread_ = values.agg(F.sum((x - F.lit(mean)) * (x - F.lit(mean)))).first()[0] if n else None
    std = math.sqrt(spread_ / (n - 1)) if n > 1 else None
    row = (n, mean, std, least, *quantiles(values, (0.25, 0.5, 0.75), n, low, high, minus, plus), most)
    number = T.DoubleType()
    fields = [("count", T.LongType()), ("mean", number), ("std", number), ("min", kind), ("p25", number), ("p50", number), ("p75", number), ("max", kind)]
    return df.sparkSession.createDataFrame([row], T.StructType([T.StructField(*f) for f in fields]))


def date_range(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.agg(F.min(c).alias("First"), F.max(c).alias("Last"), F.count_if(c.isNull()).alias("Unparsed"))


def distinct_and_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values and null share per column. Each column is counted per value in its own grouping set,
    so the distinct values are spread over the tasks."""
    sets = df.groupingSets([[F.col(c)] for c in columns], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_rows")
    )
    ids = {c: sum(1 << (len(columns) - 1 - i) for i in range(len(columns)) if i != j)
           for j, c in enumerate(columns)}
    name = F.coalesce(*[F.when(F.col("_set") == i, F.lit(c)) for c, i in ids.items()])
    value_missing = F.coalesce(*[F.when(F.col("_set") == i, F.col(f"`{c}`").isNull()) for c, i in ids.items()])
    return (
        sets.groupBy(name.alias("Column"))
        .agg(
            F.count_if(~value_missing).alias("Distinct_Values"),
            (F.sum(F.when(value_missing, F.col("_rows")).otherwise(0)) / F.sum("_rows")).alias("Null_Share"),
        )
        .orderBy("Column")
    )
