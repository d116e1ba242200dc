"""TF-IDF features: terms and vocabulary by DataFrame operations, weights by Spark ML.

The number of different phrases grows nearly with the texts. So terms are counted within their text first, then added up
by term, and the vocabulary is cut before anything is collected: a histogram of the term frequencies gives the frequency
at the cut, and only terms that stand at it are ordered.

Models count from the cleaned text itself, in Arrow batches where it lies: words are numbers there, a phrase is a pair
of numbers, and only a phrase that is handed on (different ones of some texts, or none) becomes a string. Most different
phrases are rare and stay behind: a first pass adds up occurrences by a hash of the phrase, and only phrases whose sum, which
is no smaller than their own count, can reach the vocabulary are counted by themselves.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, Window as W, functions as F

from casemill.functions import text
from casemill.functions.arrays import counted
from casemill.params import DEFAULTS, Params
from casemill.session import stage

TERMS, COUNTS, WEIGHTED, FEATURES = "terms", "term_counts", "weighted", "features"
BYTES_AT_ONCE = 2 << 20  # text whose terms a task holds at a time, in bytes
BUCKETS, SLICE = 1 << 20, 1 << 14  # sums by hash, and how many of them travel as one row; powers of two
_NEXT, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def with_terms(
    df: DataFrame, clean: str = "clean_text", ngram_max: int = DEFAULTS.ngram_max,
    stop_words: Sequence[str] = text.STOP_WORDS,
) -> DataFrame:
    """Words of two letters or more without stop words, and the n-grams over what is left."""
    words = text.drop_stop_words(text.tokens(F.col(clean)), stop_words)
    return df.withColumn("_words", words).withColumn(TERMS, text.ngrams_up_to(F.col("_words"), ngram_max)).drop("_words")


def frequent_terms(counts: DataFrame, size: int, min_df: int) -> DataFrame:
    """``term, df, tf`` of the ``size`` most frequent terms among those in at least ``min_df`` documents; ties by term. ``counts``
    has a row ``term, n`` for each document and term."""
    return _most_frequent(counts.select("term", F.lit(1).alias("df"), F.col("n").alias("tf")), size, min_df)


def _most_frequent(counts: DataFrame, size: int, min_df: int) -> DataFrame:
    """``frequent_terms`` from ``term, df, tf`` of parts of the documents."""
    return _cut(stage(_added_up(counts).where(F.col("df") >= min_df), "terms-held"), size)


def _added_up(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))


def _cut(held: DataFrame, size: int) -> DataFrame:
    """The ``size`` most frequent of the stored terms; ties by term."""
    steps = held.groupBy("tf").agg(F.count(F.lit(1)).alias("terms"))
    upto = steps.withColumn("upto", F.sum("terms").over(W.orderBy(F.desc("tf"))))  # one row for each frequency that occurs
    full = upto.where(F.col("upto") <= size).agg(F.max("upto").alias("taken"), F.min("tf").alias("least"))
    cut = upto.where(F.col("upto") > size).agg(F.max("tf").alias("at"))
    taken, at = F.coalesce(full.select("taken").scalar(), F.lit(0)), cut.scalar()
    above = held.where(at.isNull() | (F.col("tf") > at))
    edge = held.where(F.col("tf") == at).withColumn("place", F.row_number().over(W.partitionBy("tf").orderBy("term"))).where(F.col("place") <= size)
    return above.union(edge.where(F.col("place") <= F.lit(size) - taken).drop("place"))


def _parts(texts: pa.Array) -> Iterator[pa.Array]:
    """Neighbouring texts of some megabytes; a longer text is a part by itself."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    ends = [*(np.flatnonzero(np.diff(size // BYTES_AT_ONCE)) + 1), len(texts)]
    for begin, end in zip([0, *ends], ends):
        yield texts.slice(begin, end - begin)


def _words(texts: pa.Array, stop_words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of some cleaned texts, then the number of each word that is kept and the text it stands in."""
    lists = pc.split_pattern(texts, " ")
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    kept = pc.and_not(pc.greater_equal(pc.utf8_length(coded.dictionary), 2), pc.is_in(coded.dictionary, value_set=stop_words))
    word = coded.indices.to_numpy().astype(np.int64)
    keep = kept.to_numpy(zero_copy_only=False)[word] if len(word) else np.zeros(0, bool)
    return coded.dictionary, word[keep], np.repeat(np.arange(len(texts)), lengths)[keep]


def _longer(begin: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Which phrases that begin at ``begin`` have an ``n``-th word in their text."""
    inside = begin + n - 1 < len(doc)
    inside[inside] = doc[begin[inside]] == doc[begin[inside] + n - 1]
    return inside


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def _buckets(code: np.ndarray, count: int) -> np.ndarray:
    code = (code ^ (code >> np.uint64(32))) * _MIX
    return (code >> np.uint64(65 - count.bit_length())).astype(np.int64)


def _bucket_sums(texts: pa.Array, ngram_max: int, stop_words: pa.Array, out: np.ndarray) -> None:
    """Adds to ``out`` how often phrases of each bucket stand in some texts."""
    names, word, doc = _words(texts, stop_words)
    hashes = _hashes(names)
    begin, code = np.arange(len(word)), hashes[word]
    for n in range(1, ngram_max + 1):
        if n > 1:
            inside = _longer(begin, doc, n)
            begin = begin[inside]
            code = code[inside] * _NEXT + hashes[word[begin + n - 1]]
        out += np.bincount(_buckets(code, len(out)), minlength=len(out))


def bucket_sums(df: DataFrame, clean: str, ngram_max: int, stop_words: Sequence[str]) -> np.ndarray:
    """Occurrences of the terms of all texts by their bucket: no term occurs more often than the sum of its bucket says."""
    stop, schema, count, width = pa.array(stop_words, pa.string()), "slice int, n binary", BUCKETS, SLICE

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(count, np.int64)
        for batch in batches:
            for part in _parts(batch.column(0)):
                _bucket_sums(part, ngram_max, stop, out)
        rows = out.reshape(-1, width)
        at = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([r.tobytes() for r in rows[at]], pa.binary())], ["slice", "n"])

    def total(rows: pa.Table) -> pa.Table:
        n = sum(np.frombuffer(r.as_py(), np.int64) for r in rows.column("n"))
        return pa.table({"slice": pa.array(rows.column("slice").to_pylist()[:1], pa.int32()), "n": pa.array([n.tobytes()], pa.binary())})

    found = df.select(clean).mapInArrow(add, schema).groupBy("slice").applyInArrow(total, schema).toArrow()
    out = np.zeros((count // width, width), np.int64)
    for at, n in zip(found.column("slice").to_pylist(), found.column("n").to_pylist()):
        out[at] = np.frombuffer(n, np.int64)
    return out.ravel()


def _counted_terms(texts: pa.Array, ngram_max: int, stop_words: pa.Array, asked: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """``term, df, tf`` of some texts, phrases of each length by themselves; only those of the buckets ``asked`` for."""
    names, word, doc = _words(texts, stop_words)
    words, bits = names, len(texts).bit_length()
    begin, phrase = np.arange(len(word)), word
    hashes = None if asked is None else _hashes(names)
    code = None if asked is None else hashes[word]
    for n in range(1, ngram_max + 1):
        if n > 1:
            inside = _longer(begin, doc, n)
            begin = begin[inside]
            phrase = phrase[inside] * len(words) + word[begin + n - 1]
            if asked is not None:
                code = code[inside] * _NEXT + hashes[word[begin + n - 1]]
                if n == ngram_max:  # no longer phrase begins with one that is not asked for
                    kept = asked[_buckets(code, len(asked))]
                    begin, phrase, code = begin[kept], phrase[kept], code[kept]
            found, phrase = np.unique(phrase, return_inverse=True)
            names = pc.binary_join_element_wise(names.take(pa.array(found // max(len(words), 1))), words.take(pa.array(found % max(len(words), 1))), " ")
        held = phrase << bits | doc[begin]  # one value for a phrase in a text
        held = np.sort(held if asked is None else held[asked[_buckets(code, len(asked))]])
        once = held[_runs(held)] >> bits
        held >>= bits
        at, first = _runs(held), _runs(once)
        yield pa.RecordBatch.from_arrays([
            names.take(pa.array(held[at])), pa.array(np.diff(np.append(first, len(once)))), pa.array(np.diff(np.append(at, len(held))))], ["term", "df", "tf"])


def counted_terms(
    df: DataFrame, clean: str = "clean_text", ngram_max: int = DEFAULTS.ngram_max, stop_words: Sequence[str] = text.STOP_WORDS,
    asked: np.ndarray | None = None,
) -> DataFrame:
    """``term, df, tf``: the terms of ``with_terms``, added up over some texts at a time; a term has several rows. ``asked``: the
    buckets whose terms are counted, else all."""
    stop = pa.array(stop_words, pa.string())
    sent = None if asked is None else df.sparkSession.sparkContext.broadcast(asked)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch.column(0)):
                yield from _counted_terms(part, ngram_max, stop, sent and sent.value)

    return df.select(clean).mapInArrow(count, "term string, df bigint, tf bigint")


def _frequent_in_texts(df: DataFrame, size: int, min_df: int, ngram_max: int, stop_words: Sequence[str], clean: str = "clean_text") -> DataFrame:
    """``frequent_terms`` of cleaned texts. A first guess at the frequency at the cut comes from the buckets; all terms at or above
    it are counted. Where fewer than ``size`` of them are in ``min_df`` documents, the guess is lowered, down to all terms."""
    sums = bucket_sums(df, clean, ngram_max, stop_words)
    least = int(np.partition(sums, -size)[-size]) // 2 if 0 < size <= BUCKETS else 1
    while True:
        least = max(least, 1)
        counts = _added_up(counted_terms(df, clean, ngram_max, stop_words, sums >= least))
        held = stage(counts.where((F.col("df") >= min_df) & (F.col("tf") >= least)), "terms-held")
        if least == 1 or held.count() >= size:
            return _cut(held, size)
        least //= 8


class Vocabulary:
    """Terms by their words: a phrase is found by the number of its beginning and the number of its last word."""

    def __init__(self, terms: Sequence[str]) -> None:
        split = [t.split(" ") for t in terms]
        words = list(dict.fromkeys(w for s in split for w in s))
        self.size, self.words = len(terms), pa.array(words, pa.string())
        number, known = {w: i for i, w in enumerate(words)}, {(w,): i for i, w in enumerate(words)}
        at = {tuple(s): i for i, s in enumerate(split)}
        self.terms = [np.array([at.get((w,), -1) for w in words], np.int64)]  # by length: the term of a phrase, -1 if it only begins one
        self.keys = []
        for n in range(2, max(map(len, split), default=1) + 1):
            phrases = list(dict.fromkeys(tuple(s[:n]) for s in split if len(s) >= n))
            self.keys.append(pa.array([known[s[:-1]] * len(words) + number[s[-1]] for s in phrases], pa.int64()))
            self.terms.append(np.array([at.get(s, -1) for s in phrases], np.int64))
            known = {s: i for i, s in enumerate(phrases)}

    def held(self, texts: pa.Array, stop_words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, term and how often the text holds the term, in the order of texts and terms."""
        names, word, doc = _words(texts, stop_words)
        word = _index(names, self.words)[word] if len(word) else word
        begin = np.flatnonzero(word >= 0)
        phrase, found = word[begin], []
        for n, terms in enumerate(self.terms, 1):
            if n > 1:
                inside = _longer(begin, doc, n)
                begin, phrase = begin[inside], phrase[inside]
                last = word[begin + n - 1]
                at = _index(pa.array(phrase * len(self.words) + last), self.keys[n - 2])
                hit = (last >= 0) & (at >= 0)
                begin, phrase = begin[hit], at[hit]
            term = terms[phrase]
            found.append((doc[begin] * self.size + term)[term >= 0])
        held = np.sort(np.concatenate(found))
        at = _runs(held)
        return *np.divmod(held[at], max(self.size, 1)), np.diff(np.append(at, len(held)))

    def lists(self, texts: pa.Array, stop_words: pa.Array, kind: type = np.int32) -> list[pa.Array]:
        """For each text its terms and how often it holds them."""
        doc, term, n = self.held(texts, stop_words)
        ends = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32))
        return [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (term.astype(np.int32), n.astype(kind))]

    def counts(self, texts: pa.Array, stop_words: pa.Array) -> pa.Array:
        """A sparse vector for each text, in the layout of Spark's vectors."""
        lists = self.lists(texts, stop_words, float)
        kind, size = np.zeros(len(texts), np.int8), np.full(len(texts), self.size, np.int32)
        return pa.StructArray.from_arrays([pa.array(kind), pa.array(size), *lists], ["type", "size", "indices", "values"])


def _index(values: pa.Array, known: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.index_in(values, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def with_counts(
    df: DataFrame, vocabulary: CountVectorizerModel, clean: str = "clean_text", stop_words: Sequence[str] = text.STOP_WORDS,
) -> DataFrame:
    """How often each text holds the terms of the vocabulary: ``vocabulary.transform(with_terms(df))``, without the terms as strings."""
    known, stop = Vocabulary(vocabulary.vocabulary), pa.array(stop_words, pa.string())

    def count(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([known.counts(part, stop) for part in _parts(texts)])

    return df.withColumn(COUNTS, F.arrow_udf(count, VectorUDT())(F.col(clean)))


def term_numbers(df: DataFrame, terms: Sequence[str], clean: str = "clean_text", stop_words: Sequence[str] = text.STOP_WORDS) -> DataFrame:
    """``term, n`` of each text: the numbers of the ``terms`` it holds, in ascending order, and how often it holds them."""
    known, stop = Vocabulary(terms), pa.array(stop_words, pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch.column(0)):
                yield pa.RecordBatch.from_arrays(known.lists(part, stop), ["term", "n"])

    return df.select(clean).mapInArrow(count, "term array<int>, n array<int>")


def apply_model(model: PipelineModel, df: DataFrame) -> DataFrame:
    """A model that begins with a vocabulary, over rows with terms made before or with ``clean_text``."""
    if TERMS in df.columns:
        return model.transform(df)
    return PipelineModel(model.stages[1:]).transform(with_counts(df, model.stages[0]))


def fit_vocabulary(
    df: DataFrame, size: int, min_df: int, terms: str = TERMS, ngram_max: int = DEFAULTS.ngram_max,
    stop_words: Sequence[str] = text.STOP_WORDS,
) -> CountVectorizerModel:
    """The ``size`` most frequent terms among those in at least ``min_df`` documents; no more than these are collected. Rows
    without ``terms`` are counted from ``clean_text``."""
    if terms in df.columns:
        frequent = frequent_terms(df.select(F.inline(counted(F.col(terms)))), size, min_df)
    else:
        frequent = _frequent_in_texts(df, size, min_df, ngram_max, stop_words)
    found = frequent.orderBy(F.desc("tf"), "term").collect()
    if not found:
        raise ValueError(f"no term is in {min_df} documents")
    return CountVectorizerModel.from_vocabulary([r["term"] for r in found], inputCol=terms, outputCol=COUNTS)


def fit_tfidfs(df: DataFrame, p: Params, sizes: Sequence[int]) -> dict[int, PipelineModel]:
    """``fit_tfidf`` for several vocabularies in one go: the terms have an order, so a smaller vocabulary is the beginning of a
    larger one, and the weight of a term does not depend on the others."""
    largest = fit_vocabulary(df, max(sizes), p.min_df, ngram_max=p.ngram_max)
    weights = IDF(inputCol=COUNTS, outputCol=WEIGHTED).fit(apply_model(PipelineModel([largest]), df)).idf.toArray() + 1.0

    def first(size: int) -> PipelineModel:
        return PipelineModel(
            [
                CountVectorizerModel.from_vocabulary(largest.vocabulary[:size], inputCol=TERMS, outputCol=COUNTS),
                ElementwiseProduct(scalingVec=Vectors.dense(weights[:size]), inputCol=COUNTS, outputCol=WEIGHTED),
                Normalizer(inputCol=WEIGHTED, outputCol=FEATURES),
            ]
        )

    return {size: first(size) for size in sizes}


def fit_tfidf(df: DataFrame, p: Params = DEFAULTS, size: int | None = None) -> PipelineModel:
    """Counts times (1 + smoothed inverse document frequency), scaled to length 1. Fit it on training rows only."""
    return fit_tfidfs(df, p, [size or p.vocabulary])[size or p.vocabulary]
