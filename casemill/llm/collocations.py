"""Collocations: phrases that occur more often than their parts let expect, from sorted streams of counts.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words ``[^\\x20\\x09]+``. For each
language n counts all words, f(phrase) all occurrences of a phrase within pieces. Candidates are phrases of 2 to
``longest`` words with a = f(phrase) >= ``least``. Cut after its first k words, a candidate has l = f(first part), r =
f(rest) and score floor(scale * a / (l + r)); the cut with the lowest score counts, ties to the smallest k. A candidate is
dropped if a longer one contains it with 100 f(longer) >= ``swallow`` a; as no phrase is rarer than a longer one around it,
those longer by one word decide. The ``first`` best of a language by score, a and phrase are returned.

Rows
    Null and empty texts: no words. Null language: ``und``, together with the rows that say so. Repeated rows and null
    ids count as documents of their own. Very long texts are cut into chunks between pieces. Empty table: no rows. Other
    columns are ignored.

Method
    * Each task numbers the words of a chunk; the words of all chunks are counted, frequent ones get a number by their
      order, and the chunks are written once more in these numbers (a rarer word ends a piece: no phrase holds it).
    * From each place of a chunk starts a string of at most ``longest`` words. A chunk sorts and counts its strings and
      deals them by range into segments; a segment merges them and reads f of all lengths off the sorted stream. Only
      the phrases at its ends may go on in the next segment; their counts are added up afterwards.
    * The stream of frequent phrases is kept in two orders: by first words (every phrase stands right behind its
      beginnings) and by last words. A lockstep pass over each gives l or r of all cuts, and hands the counts of phrases
      longer by one word back to their beginnings and ends. Beginnings that reach over several segments are sent to
      all of them. No table of hashes, no broadcast: segments are bounded, whatever word is frequent.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from casemill.llm.blocks import flat, lists, partitions
from casemill.llm.textbatch import U, column_bytes
from casemill.session import stage


@dataclass(frozen=True)
class Collocations:
    longest: int = 4
    least: int = 30
    scale: int = 2_000_000
    swallow: int = 80
    first: int = 2000
    chunk_words: int = 200_000
    segments_per_partition: int = 2
    sample_per_segment: int = 40

    def __post_init__(self) -> None:
        if not 2 <= self.longest <= 4 or self.least < 1:
            raise ValueError("phrases have 2 to 4 words and occur once at least")


# Characters that end a piece; the other characters that bytes.split() takes as blanks are among them.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes(0x2E if b in _ENDS else b + 32 if 65 <= b <= 90 else b for b in range(256))

CHUNKS = "lang string, words array<binary>, counts array<bigint>, tokens array<int>"


def chunked(docs: DataFrame, p: Collocations) -> DataFrame:
    """``chunk, lang, words, counts, tokens``: the words of about ``chunk_words`` tokens of a language, their counts, and
    the tokens as places in that list; -1 ends a piece."""
    def pack(lang: str, tokens: list[bytes]) -> pa.RecordBatch:
        found = Counter(tokens)
        found.pop(b".", None)
        number = dict(zip(found, count()))
        number[b"."] = -1
        return pa.RecordBatch.from_arrays([
            pa.array([lang]), pa.array([list(found)], pa.list_(pa.binary())), pa.array([list(found.values())], pa.list_(pa.int64())),
            pa.array([np.fromiter(map(number.__getitem__, tokens), np.int32, len(tokens))], pa.list_(pa.int32())),
        ], names=["lang", "words", "counts", "tokens"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, list[bytes]] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), column_bytes(batch, "text")):
                tokens = open_.setdefault(lang, [])
                tokens += text.translate(_PLAIN).replace(b".", b" . ").split()
                tokens.append(b".")
                while len(tokens) >= p.chunk_words:
                    # between pieces; a piece longer than a chunk stays whole
                    at = len(tokens) - 1 if len(tokens) < 2 * p.chunk_words else tokens.index(b".", p.chunk_words)
                    yield pack(lang, tokens[: at + 1])
                    del tokens[: at + 1]
            if sum(map(len, open_.values())) > 4 * p.chunk_words:
                for lang in list(open_):
                    yield pack(lang, open_.pop(lang))
        for lang, tokens in open_.items():
            if tokens:
                yield pack(lang, tokens)

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return stage(rows.mapInArrow(task, CHUNKS).withColumn("chunk", F.monotonically_increasing_id()), "phrase-chunks")


def numbered(counts: DataFrame, p: Collocations) -> DataFrame:
    """``lang, word, id`` of the words that occur ``least`` times, numbered from 1 in the order of language and word."""
    often = counts.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= p.least)
    sorted_ = often.repartitionByRange(partitions(counts), "lang", "word").sortWithinPartitions("lang", "word")
    words = stage(sorted_.withColumn("at", F.monotonically_increasing_id()), "phrase-words")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = sorted(words.groupBy(part.alias("part")).count().collect())
    before, total = {}, 1
    for k, n in sizes:
        before[k] = total
        total += n
    if total >= 1 << 31:
        raise ValueError("more than 2^31 frequent words")
    start = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[part] if before else F.lit(0)
    return words.select("lang", "word", (start + place).cast("int").alias("id"))


def encoded(chunks: DataFrame, ids: DataFrame) -> DataFrame:
    """``chunk, tokens``: the tokens as word numbers; 0 where a piece ends or a rarer word stands."""
    own = chunks.select("chunk", "lang", F.posexplode("words").alias("place", "word"))
    own = own.join(ids, ["lang", "word"]).select(F.col("chunk").alias("of"), "place", "id")

    def write(left: pa.Table, right: pa.Table) -> pa.Table:
        tokens = left.column("tokens").combine_chunks().flatten().to_numpy()
        table = np.zeros(int(tokens.max(initial=-1)) + 2, np.int32)  # the last one is for -1
        if right.num_rows:
            table[right.column("place").to_numpy()] = right.column("id").to_numpy()
        return pa.table([left.column("chunk"), pa.array([table[tokens]], pa.list_(pa.int32()))], names=["chunk", "tokens"])

    both = chunks.select("chunk", "tokens").groupBy("chunk").cogroup(own.groupBy("of"))
    return stage(both.applyInArrow(write, "chunk bigint, tokens array<int>"), "phrase-tokens")


def strings(tokens: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """From each word that does not end a piece the next ``longest`` words, 0 from the end of the piece on, as two numbers."""
    t = np.concatenate([tokens, np.zeros(4, tokens.dtype)]).astype(U)
    at = np.flatnonzero(tokens)
    w = [t[at]]
    for j in range(1, 4):
        w.append(np.where(w[-1] > 0, t[at + j], U(0)) if j < longest else np.zeros(len(at), U))
    return w[0] << U(32) | w[1], w[2] << U(32) | w[3]


def merged(hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct strings in order, with the sums of their counts."""
    if not len(hi):
        return hi, lo, n
    order = np.lexsort((lo, hi))
    hi, lo, n = hi[order], lo[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])]))
    return hi[first], lo[first], np.add.reduceat(n, first)


_MASKS = [(0xFFFFFFFF00000000, 0), (0xFFFFFFFFFFFFFFFF, 0), (0xFFFFFFFFFFFFFFFF, 0xFFFFFFFF00000000), (0xFFFFFFFFFFFFFFFF, 0xFFFFFFFFFFFFFFFF)]
MASKS = [(U(a), U(b)) for a, b in _MASKS]
WHOLE = U(0xFFFFFFFFFFFFFFFF)


def order_of(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Number of words of each phrase."""
    low = U(0xFFFFFFFF)
    return 1 + (hi & low > 0).astype(int) + (lo >> U(32) > 0) + (lo & low > 0)


def turned(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrases with their words in reverse."""
    w = np.stack([hi >> U(32), hi & U(0xFFFFFFFF), lo >> U(32), lo & U(0xFFFFFFFF)])
    k = order_of(hi, lo)
    out = np.zeros_like(w)
    for size in range(1, 5):
        of = k == size
        out[:size, of] = w[:size, of][::-1]
    return out[0] << U(32) | out[1], out[2] << U(32) | out[3]


@dataclass(frozen=True)
class Bounds:
    """First string of each segment but the first."""

    hi: np.ndarray
    lo: np.ndarray

    def segment(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Segment of each string: the number of bounds not above it."""
        out = np.searchsorted(self.hi, hi, side="left")
        ends = np.searchsorted(self.hi, hi, side="right")
        for k in np.flatnonzero(ends > out):
            out[k] += np.searchsorted(self.lo[out[k] : ends[k]], lo[k], side="right")
        return out


def bounds_of(sample: DataFrame, segments: int) -> Bounds:
    """Bounds that cut a bounded sample of strings (two columns of signed 64-bit numbers) into equal parts."""
    got = sample.toArrow()
    hi, lo = (got.column(c).to_numpy().view(U) for c in ("hi", "lo"))
    order = np.lexsort((lo, hi))
    cut = order[(np.arange(1, segments) * len(order)) // segments] if len(order) else order
    hi, lo, _ = merged(hi[cut], lo[cut], np.ones(len(cut), np.int64))
    return Bounds(hi, lo)


STRINGS = "segment int, hi array<bigint>, lo array<bigint>, n array<bigint>"
SAMPLE = "hi bigint, lo bigint"


def phrase_counts(tokens: DataFrame, p: Collocations) -> DataFrame:
    """``hi, lo, a`` of all phrases of 1 to ``longest`` frequent words with f >= ``least``."""
    segments = p.segments_per_partition * partitions(tokens)
    want = segments * p.sample_per_segment
    chunks = max(tokens.count(), 1)
    thin = max(1, chunks // max(want // 16, 1))  # every thin-th chunk gives some places, so a bounded sample in all
    places = max(1, -(-want * thin // chunks))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column("tokens"):
                hi, lo = strings(t.values.to_numpy(), p.longest)
                at = np.unique(np.linspace(0, len(hi) - 1, min(places, len(hi))).astype(int)) if len(hi) else np.zeros(0, int)
                yield pa.RecordBatch.from_arrays([pa.array(hi[at].view(np.int64)), pa.array(lo[at].view(np.int64))], names=["hi", "lo"])

    seen = tokens.where(F.pmod(F.xxhash64("chunk"), F.lit(thin)) == 0).select("tokens")
    bounds = bounds_of(seen.mapInArrow(some, SAMPLE), segments)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column("tokens"):
                hi, lo = strings(t.values.to_numpy(), p.longest)
                hi, lo, n = merged(hi, lo, np.ones(len(hi), np.int64))
                if not len(hi):
                    continue
                of = bounds.segment(hi, lo) if len(hi) < 64 else _by_bounds(bounds, hi, lo)
                numbers, begin = np.unique(of, return_index=True)
                begin = np.append(begin, len(hi))
                yield pa.RecordBatch.from_arrays([pa.array(numbers.astype(np.int32)), *[lists(x, begin) for x in (hi, lo, n)]],
                                                 names=["segment", "hi", "lo", "n"])

    def read(group: pa.Table) -> pa.Table:
        hi, lo, n = merged(*[flat(group.column(c))[0] for c in ("hi", "lo")], flat(group.column("n"))[0].view(np.int64))
        out = []
        for a, b in MASKS[: p.longest]:
            x, y = hi & a, lo & b
            first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
            f = np.add.reduceat(n, first)
            full = order_of(hi[first] & a, lo[first] & b) == order_of(a.reshape(1), b.reshape(1))[0]
            open_ = np.zeros(len(first), bool)  # these may go on in another segment
            open_[[0, -1]] = True
            stays = full & (open_ | (f >= p.least))
            out.append((x[first][stays], y[first][stays], f[stays]))
        hi, lo, f = (np.concatenate(c) for c in zip(*out))
        return pa.table([pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)), pa.array(f)], names=["hi", "lo", "a"])

    dealt = tokens.select("tokens").mapInArrow(deal, STRINGS)
    found = dealt.groupBy("segment").applyInArrow(read, "hi bigint, lo bigint, a bigint")
    whole = found.groupBy("hi", "lo").agg(F.sum("a").alias("a")).where(F.col("a") >= p.least)
    return stage(whole, "phrase-counts")


def _by_bounds(bounds: Bounds, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """As ``segment``, for sorted strings: the bounds are looked up instead of the strings."""
    begin = np.searchsorted(hi, bounds.hi, side="left")
    end = np.searchsorted(hi, bounds.hi, side="right")
    at = np.array([b + np.searchsorted(lo[b:e], x, side="left") for b, e, x in zip(begin.tolist(), end.tolist(), bounds.lo)], np.int64)
    return np.searchsorted(at, np.arange(len(hi)), side="right")


PARTS = "hi bigint, lo bigint, a bigint, part1 bigint, part2 bigint, part3 bigint, longer bigint"


def lockstep(counts: DataFrame, reverse: bool) -> DataFrame:
    """One pass over the stream by first (or last) words: for each phrase the counts of its beginnings (ends) of 1 to 3
    words, and for each beginning (end) the largest count of a phrase longer by one word. A phrase may have several rows."""
    segments = partitions(counts)
    n = counts.count()
    m = max(1, n // (40 * segments))

    def turn(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hi, lo, a = (batch.column(c).to_numpy().copy() for c in ("hi", "lo", "a"))
        hi, lo = hi.view(U), lo.view(U)
        return (*turned(hi, lo), a) if reverse else (hi, lo, a)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hi, lo, _ = turn(batch)
            yield pa.RecordBatch.from_arrays([pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64))], names=["hi", "lo"])

    sample = counts.where(F.pmod(F.xxhash64("hi", "lo"), F.lit(m)) == 0)
    bounds = bounds_of(sample.mapInArrow(keys, SAMPLE), segments)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hi, lo, a = turn(batch)
            own = bounds.segment(hi, lo)
            k = order_of(hi, lo) - 1
            top = np.array([(~x, ~y) for x, y in MASKS], U)
            last = bounds.segment(hi | top[k, 0], lo | top[k, 1])  # where the longer phrases that begin so end
            times = last - own + 1
            row = np.repeat(np.arange(len(hi)), times)
            segment = own[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            yield pa.RecordBatch.from_arrays([
                pa.array(segment.astype(np.int32)), pa.array(segment == own[row]), pa.array(hi[row].view(np.int64)),
                pa.array(lo[row].view(np.int64)), pa.array(a[row]),
            ], names=["segment", "own", "hi", "lo", "a"])

    def walk(group: pa.Table) -> pa.Table:
        hi, lo = (group.column(c).to_numpy().view(U) for c in ("hi", "lo"))
        order = np.lexsort((lo, hi))
        hi, lo = hi[order], lo[order]
        a, own = group.column("a").to_numpy()[order], group.column("own").to_numpy(zero_copy_only=False)[order]
        k = order_of(hi, lo)
        place = np.arange(len(hi))
        parts, longer = [], np.zeros(len(hi), np.int64)
        for size in (1, 2, 3):
            at = np.maximum.accumulate(np.where(k == size, place, -1))  # the last phrase of this size so far
            x, y = MASKS[size - 1]
            same = (at >= 0) & (k > size) & (hi[at] == hi & x) & (lo[at] == lo & y)
            parts.append(pa.array(np.where(same, a[at], 0), mask=~same))
            next_ = same & (k == size + 1)
            np.maximum.at(longer, at[next_], a[next_])
        if reverse:
            hi, lo = turned(hi, lo)
        out = pa.table([pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)), pa.array(a), *parts, pa.array(longer)],
                       names=["hi", "lo", "a", "part1", "part2", "part3", "longer"])
        return out.filter(pa.array(own | (longer > 0)))

    sent = counts.mapInArrow(send, "segment int, own boolean, hi bigint, lo bigint, a bigint")
    return sent.groupBy("segment").applyInArrow(walk, PARTS)


def scored(counts: DataFrame, p: Collocations) -> DataFrame:
    """``w1 .. w4, a, l, r, score`` of the candidates that no longer phrase swallows."""
    left, right = lockstep(counts, False), lockstep(counts, True)
    rows = left.select("*", F.lit(True).alias("ahead")).unionByName(right.select("*", F.lit(False).alias("ahead")))
    most = lambda c, ahead: F.max(F.when(F.col("ahead") == ahead, F.col(c)))
    whole = rows.groupBy("hi", "lo").agg(
        F.max("a").alias("a"), F.max("longer").alias("longer"),
        *[most(f"part{j}", True).alias(f"l{j}") for j in (1, 2, 3)], *[most(f"part{j}", False).alias(f"r{j}") for j in (1, 2, 3)])
    half = lambda c, j: (F.shiftrightunsigned(c, 32) if j == 0 else F.col(c).bitwiseAND(0xFFFFFFFF)).cast("int")
    whole = whole.select("*", half("hi", 0).alias("w1"), half("hi", 1).alias("w2"), half("lo", 0).alias("w3"), half("lo", 1).alias("w4"))
    size = 1 + sum(F.when(F.col(c) > 0, 1).otherwise(0) for c in ("w2", "w3", "w4"))
    exact = lambda c: c.cast("decimal(20,0)")

    def cut(k: int) -> Column:
        l, r = F.col(f"l{k}"), F.element_at(F.array("r1", "r2", "r3"), F.col("size") - k)  # noqa: E741
        score = F.call_function("div", exact(F.col("a")) * F.lit(p.scale).cast("decimal(10,0)"), exact(l) + exact(r)).cast("bigint")
        return F.when(F.col("size") > k, F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))

    kept = whole.withColumn("size", size).where(F.col("size") > 1).where(
        exact(F.col("longer")) * 100 < exact(F.col("a")) * p.swallow)
    best = F.array_min(F.array_compact(F.array(*[cut(k) for k in range(1, p.longest)])))
    return kept.withColumn("cut", best).select("w1", "w2", "w3", "w4", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, p: Collocations = Collocations()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``."""
    chunks = chunked(docs, p)
    words = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).select("lang", F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
    totals = chunks.select("lang", F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    ids = stage(numbered(words, p), "phrase-ids")
    found = scored(phrase_counts(encoded(chunks, ids), p), p)
    name = ids.select(F.col("id").alias("w1"), "lang")
    order = [F.desc("score"), F.desc("a")]
    top = found.join(name, "w1").withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= p.first)
    top = stage(top, "phrase-top")
    spelled = top.select("w1", "w2", "w3", "w4", F.posexplode(F.array("w1", "w2", "w3", "w4")).alias("j", "id")).where("id > 0").join(
        ids.select("id", "word"), "id")
    # the keys of one phrase are its own words, so a group has four rows at most
    phrases = spelled.groupBy("w1", "w2", "w3", "w4").agg(F.sort_array(F.collect_list(F.struct("j", "word"))).alias("words"))
    text = F.array_join(F.transform("words", lambda w: w["word"].cast("string")), " ")
    out = top.join(phrases, ["w1", "w2", "w3", "w4"]).join(totals, "lang").withColumn("phrase", text)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    out = out.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= p.first)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
