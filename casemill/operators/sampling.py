"""Reproducible exact samples and stratified splits without collecting a stratum anywhere.

Rows are ordered by a digest of seed and id, which spreads evenly. Counts per leading hex digits tell which rows
are taken whole; the digits where the quota falls are looked at more closely in a second step. Each step has few
groups per stratum, so every task adds up its own rows before the shuffle, and only the rows of the last prefix,
about one in a million, are sorted. A stratum with a third of all rows is no problem. Ids are unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from casemill.functions.arrays import key_of, sorted_match
from casemill.params import DEFAULTS
from casemill.session import stage

LEVELS = (2, 5)  # leading hex digits looked at in each step
_ONE = "_all"
SMALL_TABLE = 100_000  # keys that travel as an array, some MB at most


def digest(id_column: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), id_column.cast("string")))


def _prefix(length: int) -> Column:
    return F.substring("_digest", 1, length)


def _cuts(rows: DataFrame, quota: Column, stratum: str) -> DataFrame:
    """Per stratum the prefix where the quota falls and how many of its rows still belong to it. The quota may
    refer to ``_total``, the rows of the stratum."""
    keys = rows.select(F.col(stratum).alias("_s"), "_digest")
    cut = None
    for i, length in enumerate(LEVELS):
        level = keys
        if cut is not None:
            same = keys["_s"].eqNullSafe(cut["_stratum"])
            level = keys.join(cut, same).filter(_prefix(LEVELS[i - 1]) == F.col("_cut"))
        need = [] if cut is None else [F.max("_need").alias("_need")]
        counts = level.groupBy("_s", _prefix(length).alias("_p")).agg(F.count(F.lit(1)).alias("_n"), *need)
        # A few thousand prefixes per stratum at most.
        counts = counts.withColumn("_upto", F.sum("_n").over(W.partitionBy("_s").orderBy("_p")))
        if cut is None:
            counts = counts.withColumn("_total", F.sum("_n").over(W.partitionBy("_s"))).withColumn("_need", quota)
        before = F.col("_upto") - F.col("_n")
        cut = counts.filter((F.col("_upto") >= F.col("_need")) & (before < F.col("_need"))).select(
            F.col("_s").alias("_stratum"), F.col("_p").alias("_cut"), (F.col("_need") - before).alias("_need")
        )
    return cut


def _matched(rows: DataFrame, known: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with the row of ``known(k, ...)`` whose key equals the column ``key``, as a struct ``_hit``.

    Up to ``SMALL_TABLE`` keys travel as a sorted array, in which every row looks up its own: no text is shuffled, and keys
    are compared in their own type. A longer table is joined.
    """
    known = stage(known, name)
    n = known.count()
    typed = key_of(F.col(f"`{key}`"))
    if n > SMALL_TABLE:
        small = known.select(F.col("k").alias("_k"), F.struct(*known.columns).alias("_hit"))
        return rows.join(small, typed.eqNullSafe(F.col("_k")), "left").drop("_k")
    table = known.agg(F.array_sort(F.collect_list(F.struct("k", *[c for c in known.columns if c != "k"])))).scalar()
    # a column first: a subquery may not stand inside a function over arrays
    return rows.withColumn("_table", table).withColumn("_hit", sorted_match(F.col("_table"), n, typed)).drop("_table")


def _with_cut(rows: DataFrame, cut: DataFrame, stratum: str) -> DataFrame:
    """Rows with the cut of their stratum."""
    known = cut.select(key_of(F.col("_stratum")).alias("k"), "_cut", "_need")
    out = _matched(rows, known, stratum, "sample-cuts")
    return out.withColumns({"_cut": F.col("_hit._cut"), "_need": F.col("_hit._need")}).drop("_hit")


def _split(df: DataFrame, id_column: str, quota: Column, seed: int, stratum: str) -> tuple[DataFrame, DataFrame]:
    """The first ``quota`` rows of every stratum, and the other rows."""
    rows = df if stratum in df.columns else df.withColumn(stratum, F.lit(1))
    rows = rows.withColumn("_digest", digest(F.col(f"`{id_column}`"), seed))
    rows = _with_cut(rows, _cuts(rows, quota, stratum), stratum).withColumn("_p", _prefix(LEVELS[-1]))
    edge = rows.filter(F.col("_p") == F.col("_cut"))
    w = W.partitionBy(stratum, "_p").orderBy("_digest", f"`{id_column}`")
    edge = edge.withColumn("_rn", F.row_number().over(w))
    taken, rest = F.col("_rn") <= F.col("_need"), F.col("_rn") > F.col("_need")
    inside = rows.filter(F.col("_p") < F.col("_cut"))
    beyond = rows.filter(F.coalesce(F.col("_p") > F.col("_cut"), F.lit(True)))
    first = inside.select(*df.columns).unionByName(edge.filter(taken).select(*df.columns))
    second = beyond.select(*df.columns).unionByName(edge.filter(rest).select(*df.columns))
    return first, second


def sample_rows(df: DataFrame, n: int, id_column: str, seed: int = DEFAULTS.seed) -> DataFrame:
    """Exactly ``n`` rows, or all rows if there are fewer; the same ones for the same seed."""
    quota = F.least(F.lit(n), F.col("_total"))
    return _split(df, id_column, quota, seed, _ONE)[0]


def stratified_split(
    df: DataFrame, stratum: str, id_column: str, test_share: float = 0.2, seed: int = DEFAULTS.seed,
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows with the same share of every class, to the row."""
    quota = F.bround(F.col("_total") * test_share, 0).cast("long")
    test, train = _split(df, id_column, quota, seed, stratum)
    return train, test


def keep_frequent(df: DataFrame, label: str, min_rows: int) -> DataFrame:
    """Rows whose label has at least ``min_rows`` rows."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    frequent = counts.filter(F.col("_n") >= min_rows).select(key_of(F.col(label)).alias("k"))
    found = _matched(df, frequent, label, "frequent-labels")
    return found.filter(F.col("_hit").isNotNull()).select(*[F.col(f"`{c}`") for c in df.columns])
