"""Benchmark decontamination: spaced seeds, then substitution-tolerant overlaps around the hits. Columns only.

Words are runs of letters and digits, lower-cased. A mask lists the offsets of a word window that must agree; the words
between them may differ. Windows of documents and of benchmark items that agree under a mask are a hit. A hit puts the
item on a diagonal of the document; the document is contaminated if ``window`` consecutive words of the item (or all
words of a shorter item) lie there with at least ``agree`` of them equal.

The masks of an item go by its length: of the given sets the first one that, by enumeration, hits every choice of words
that may differ (36 of 455 went unseen with the masks of one set for all). An item of so few words that none may differ
is joined on all of them. Where no set does, or there are too many choices to enumerate, the mask is the run of equal
words that must be left between the others. Result rows: one for each document and item.

Rows
    Null and empty texts match nothing. Rows with null ids are left out. An item of one word is in every text that has it.
    Repeated rows give one result row. Empty tables: no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations, islice

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Decontaminate:
    # Sets of masks, those that let the fewest words pass first; a mask is the offsets that must agree.
    masks: tuple[tuple[tuple[int, ...], ...], ...] = (
        ((0, 1, 2, 4, 5), (0, 1, 3, 7, 8)), ((0, 1, 2, 4),), ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4)), ((0, 1, 2), (0, 1, 3)))
    patterns: int = 20_000
    window: int = 15
    agree: float = 0.8
    drop_from: int = 5
    broadcast_seeds: int = 1_000_000


@lru_cache
def masks_for(n: int, p: Decontaminate) -> tuple[tuple[int, ...], ...]:
    """Masks that hit ``n`` words of which all but ``agree`` of them differ, whichever these are."""
    spare = n - next(k for k in range(n + 1) if k >= p.agree * n)
    if spare == n:
        raise ValueError("words that all differ can not be found")
    gone = [set(g) for g in islice(combinations(range(n), spare), p.patterns + 1)]
    if spare and len(gone) <= p.patterns:
        for masks in p.masks:
            places = [{at + o for o in m} for m in masks for at in range(n - m[-1])]
            if all(any(not place & g for place in places) for g in gone):
                return masks
    return (tuple(range(-(-(n - spare) // (spare + 1)))),)


def word_names(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds(rows: DataFrame, masks: list[tuple[int, ...]]) -> DataFrame:
    """Rows of ``id, names`` as ``id, n, at, mask, seed``: one for each word position and mask. A seed that begins too
    near the end is of fewer words."""
    at = rows.select("id", "names", F.size("names").alias("n"), F.posexplode("names").alias("at", "_name"))
    hashes = []
    for k, mask in enumerate(masks):
        hashes += [F.lit(k), F.xxhash64(F.lit(k), *[F.get("names", F.col("at") + o) for o in mask])]
    return at.select("id", "n", "at", F.stack(F.lit(len(masks)), *hashes).alias("mask", "seed"))


def named(table: DataFrame, key: str) -> DataFrame:
    return (table.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), word_names(F.col("text")).alias("names"))
            .where(F.size("names") > 0))


def overlaps(docs: DataFrame, benchmark: DataFrame, p: Decontaminate = Decontaminate()) -> DataFrame:
    """``doc_id, item_id, first_word, n_words, n_equal`` of the best overlap of each document and item."""
    items = named(benchmark, "item_id").distinct()
    # at most ``window`` lengths; only their masks are made of the documents
    width = F.least(F.size("names"), F.lit(p.window))
    chosen = {r[0]: masks_for(r[0], p) for r in items.select(width).distinct().collect()}
    masks = sorted({m for some in chosen.values() for m in some}) or [(0,)]
    spans = F.array(*[F.lit(m[-1]) for m in masks])
    uses = F.lit(False)
    for n, some in sorted(chosen.items()):
        uses |= (F.least("n", F.lit(p.window)) == n) & F.col("mask").isin([masks.index(m) for m in some])
    own = seeds(items, masks).where(uses & (F.col("at") + F.get(spans, F.col("mask")) < F.col("n")))
    own = own.select(F.col("id").alias("item_id"), F.col("at").alias("item_at"), "seed").distinct()
    # the benchmark is a table of its own and usually small; it is sent to all tasks only if it is
    small = own.limit(p.broadcast_seeds + 1).count() <= p.broadcast_seeds
    texts = named(docs, "doc_id")
    theirs = seeds(texts, masks).select(F.col("id").alias("doc_id"), "at", "seed")
    hits = theirs.join(F.broadcast(own) if small else own, "seed")
    hits = hits.select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    # the words of a text are made again only where it was hit
    hits = hits.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "shift")).alias("hits"))
    pairs = docs.select("doc_id", "text").join(hits, "doc_id").select("doc_id", word_names(F.col("text")).alias("theirs"), F.inline("hits"))
    pairs = pairs.join(items.select(F.col("id").alias("item_id"), "names"), "item_id")
    equal = F.transform("names", lambda w, q: F.when(F.get("theirs", F.col("shift") + q) == w, 1).otherwise(0))
    pairs = pairs.select("doc_id", "item_id", "shift", F.transform(equal, lambda e: F.coalesce(e, F.lit(0))).alias("equal"))
    width = F.least(F.size("equal"), F.lit(p.window))
    scores = F.transform(F.sequence(F.lit(0), F.size("equal") - width), lambda i: F.struct(
        F.aggregate(F.slice("equal", i + 1, width), F.lit(0), lambda s, e: s + e).alias("n_equal"),
        (-i).alias("before")))
    best = pairs.select("doc_id", "item_id", "shift", width.alias("n_words"), F.array_max(scores).alias("best"))
    best = best.where(F.col("best.n_equal") >= p.agree * F.col("n_words"))
    best = best.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("best.n_equal", (-(F.col("shift") - F.col("best.before"))).alias("at"), "n_words")).alias("top"))
    return best.select("doc_id", "item_id", (-F.col("top.at")).cast("bigint").alias("first_word"),
                       F.col("top.n_words").cast("bigint").alias("n_words"), F.col("top.n_equal").cast("bigint").alias("n_equal"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, p: Decontaminate = Decontaminate()) -> DataFrame:
    """The documents without an overlap of ``drop_from`` equal words or more; all columns stay. A document without id is kept.
    An item of fewer words, such as a single common one, is reported by ``overlaps`` but drops nothing."""
    found = overlaps(docs, benchmark, p).where(F.col("n_equal") >= p.drop_from).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
