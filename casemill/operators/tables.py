"""Fitted text models as tables, and scoring over them without a model object.

A linear model is ``term, idf, weights`` (one weight per class, in class order) and ``position, label, intercept``. The
tables, which the vocabulary bounds, go to every executor; a text meets them where it lies, in Arrow batches, so neither
terms nor texts are shuffled. Softmax, canonical labels, decision and candidates are column expressions over the sums. A
topic model is ``term, weights`` (probability of the term in each topic); the topic weights of a text are the fixed point
that explains its terms best. All models are scored in one pass over the terms, which are numbers there and never strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from casemill.functions.arrays import counted, let
from casemill.functions.text import STOP_WORDS
from casemill.operators.classify import Classifier, TopicModel
from casemill.operators.predictions import canonical_scores, confidence_decision, multi_issue_record, raw_label
from casemill.operators.topics import dominant_topic
from casemill.operators.vectors import TERMS, Vocabulary, frequent_terms, with_terms
from casemill.params import DEFAULTS, Params
from casemill.session import stage

TOPIC_STEPS = 20
TEXTS_AT_ONCE = 512  # texts whose sums a task holds at a time


def term_lists(df: DataFrame, id_column: str, p: Params = DEFAULTS) -> DataFrame:
    """``id, terms``: the terms of every row with ``clean_text`` and how often it holds them, counted within the row."""
    texts = df.where(F.col("clean_text").isNotNull())
    return with_terms(texts, ngram_max=p.ngram_max).select(id_column, counted(F.col(TERMS)).alias(TERMS))


def term_counts(df: DataFrame, id_column: str, p: Params = DEFAULTS) -> DataFrame:
    """``id, term, n`` for every term of every row with ``clean_text``. Ids are unique."""
    return term_lists(df, id_column, p).select(id_column, F.inline(TERMS))


def vocabulary(counts: DataFrame, documents: Column, size: int, p: Params = DEFAULTS) -> DataFrame:
    """``term, idf`` of the ``size`` most frequent terms among those that ``min_df`` of all ``documents`` hold; ties by term."""
    found = frequent_terms(counts, size, p.min_df)
    return found.select("term", (F.log((documents + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def weights(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """``id, term, weight``: counts times idf, scaled to length 1 per document. Only terms of the vocabulary are shuffled."""
    id_column = next(c for c in counts.columns if c not in ("term", "n"))
    raw = counts.join(stage(terms, "vocabulary"), "term").select(id_column, "term", (F.col("n") * F.col("idf")).alias("w"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(id_column)))
    return raw.select(id_column, "term", (F.col("w") / length).alias("weight"))


@dataclass(frozen=True)
class LinearTable:
    terms: DataFrame
    classes: DataFrame

    @property
    def labels(self) -> list[str]:
        return [r["label"] for r in self.classes.orderBy("position").collect()]


def linear_table(classifier: Classifier) -> LinearTable:
    """The fitted classifier as tables. Its vocabulary and classes, which fitting holds on the driver, bound them."""
    found, product, _, linear = classifier.model.stages[:4]
    spark = classifier.test.sparkSession
    columns = linear.coefficientMatrix.toArray().T
    rows = [(t, float(i), c.tolist()) for t, i, c in zip(found.vocabulary, product.getScalingVec().toArray(), columns)]
    terms = spark.createDataFrame(rows, "term string, idf double, weights array<double>")
    classes = spark.createDataFrame(
        [(k, c, float(b)) for k, (c, b) in enumerate(zip(classifier.classes, linear.interceptVector.toArray()))],
        "position int, label string, intercept double")
    return LinearTable(stage(terms, "linear-terms"), stage(classes, "linear-classes"))


def topic_table(topics: TopicModel) -> DataFrame:
    """``term, weights``: the probability of the term in each topic."""
    shares = topics.weights / topics.weights.sum(axis=1, keepdims=True)
    rows = [(t, w.tolist()) for t, w in zip(topics.terms, shares.T)]
    return stage(topics.words.sparkSession.createDataFrame(rows, "term string, weights array<double>"), "topic-table")


@dataclass(frozen=True)
class Analysis:
    product: LinearTable
    issue: LinearTable
    topics: DataFrame


def save_tables(analysis: Analysis, path: str) -> None:
    folder = path.rstrip("/")
    for name in ("product", "issue"):
        getattr(analysis, name).terms.write.mode("overwrite").parquet(f"{folder}/{name}-terms")
        getattr(analysis, name).classes.write.mode("overwrite").parquet(f"{folder}/{name}-classes")
    analysis.topics.write.mode("overwrite").parquet(f"{folder}/topics")


def load_tables(spark: SparkSession, path: str) -> Analysis:
    folder = path.rstrip("/")
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    return Analysis(*[LinearTable(read(f"{n}-terms"), read(f"{n}-classes")) for n in ("product", "issue")], read("topics"))


def _softmax(margins: Column) -> Column:
    def shares(m: Column) -> Column:
        return let(F.transform(m, lambda x: F.exp(x - F.array_max(m))),
                   lambda e: let(F.aggregate(e, F.lit(0.0), lambda s, x: s + x), lambda total: F.transform(e, lambda x: x / total)))

    return let(margins, shares)


def _probability(sums: Column, length: Column, intercepts: Column) -> Column:
    """Class probabilities from the products of a text; a text without a known term has the intercepts alone."""
    scaled = F.when(length > 0, F.transform(sums, lambda s: s / length))
    return _softmax(F.zip_with(intercepts, F.coalesce(scaled, F.transform(intercepts, lambda _: F.lit(0.0))), lambda a, b: a + b))


def topic_weights(doc: np.ndarray, n: np.ndarray, share: np.ndarray, texts: int, steps: int = TOPIC_STEPS) -> np.ndarray:
    """Weights of the topics for each text, whose known terms are rows of ``doc``, ``n`` and ``share`` (probability in each
    topic): starting from equal weights, each step shares every term out among the topics by weight times probability, and
    adds 1 / k for each topic."""
    k = share.shape[1]
    theta = np.full((texts, k), 1 / k)
    for _ in range(steps):
        part = theta[doc] * share
        total = part.sum(axis=1)
        part *= np.divide(n, total, out=np.zeros_like(total), where=total > 0)[:, None]
        theta = 1 / k + np.stack([np.bincount(doc, part[:, t], texts) for t in range(k)], axis=1)
        theta /= theta.sum(axis=1, keepdims=True)
    return theta


@dataclass(frozen=True)
class _Known:
    """What the models know of each term; zeros where a model does not hold it."""
    terms: pa.Array
    linear: list[tuple[np.ndarray, np.ndarray]]  # idf, weights
    topics: np.ndarray


def _known(models: Analysis, classes: list[int]) -> _Known:
    """The tables of the models by term. The vocabulary, which fitting holds on the driver, bounds them."""
    rows = [m.collect() for m in (models.product.terms, models.issue.terms, models.topics)]
    at = {t: i for i, t in enumerate(dict.fromkeys(r["term"] for found in rows for r in found))}

    def spread_out(found: list, column: str, width: int) -> np.ndarray:
        out = np.zeros((len(at), width))
        if found:
            out[[at[r["term"]] for r in found]] = np.array([r[column] for r in found], dtype=float).reshape(len(found), -1)
        return out

    linear = [(spread_out(found, "idf", 1)[:, 0], spread_out(found, "weights", width)) for found, width in zip(rows, classes)]
    return _Known(pa.array(at, pa.string()), linear, spread_out(rows[2], "weights", len(rows[2][0]["weights"]) if rows[2] else 1))


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel().astype(float)))


def _sums(terms: pa.Array, known: _Known) -> list[pa.Array]:
    """For each linear model the products added up by class and the length, then the topic weights, of some texts given as
    lists of terms."""
    texts, size = len(terms), max(len(known.terms), 1)
    lengths = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False)
    at = pc.fill_null(pc.index_in(terms.flatten(), value_set=known.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(texts), lengths)
    pairs, n = np.unique((doc * size + at)[at >= 0], return_counts=True)
    return _sums_of(*np.divmod(pairs, size), n, texts, known)


def _sums_of(doc: np.ndarray, at: np.ndarray, n: np.ndarray, texts: int, known: _Known) -> list[pa.Array]:
    """``_sums`` of texts ``doc`` that hold the term ``at`` ``n`` times."""
    n, out = n.astype(float), []
    for idf, weights in known.linear:
        w = n * idf[at]
        out.append(_lists(np.stack([np.bincount(doc, w * column[at], texts) for column in weights.T], axis=1)))
        out.append(pa.array(np.sqrt(np.bincount(doc, w * w, texts)).astype(float)))
    held = known.topics.any(axis=1)[at]
    return [*out, _lists(topic_weights(doc[held], n[held], known.topics[at[held]], texts))]


SUMS = "_product array<double>, _product_length double, _issue array<double>, _issue_length double, _topics array<double>"


def analyzed(df: DataFrame, id_column: str, models: Analysis, product_names: dict[str, str], issue_names: dict[str, str],
             p: Params = DEFAULTS) -> DataFrame:
    """Product record, issue record, candidates, and topic of every row whose ``clean_text`` is not empty; ids are unique."""
    rows = df.where(F.length("clean_text") > 0)
    labels, intercepts = {}, {}
    for name, model in (("product", models.product), ("issue", models.issue)):
        classes = model.classes.orderBy("position").collect()
        labels[name] = [r["label"] for r in classes]
        intercepts[name] = F.array(*[F.lit(r["intercept"]) for r in classes])
    tables_ = _known(models, [len(labels[name]) for name in ("product", "issue")])
    numbers, stop = Vocabulary(tables_.terms.to_pylist()), pa.array(STOP_WORDS, pa.string())
    known = df.sparkSession.sparkContext.broadcast((tables_, numbers))

    columns, schema = df.columns, T.StructType([*df.schema.fields, *T.StructType.fromDDL(SUMS).fields])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables_, numbers = known.value
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(i, TEXTS_AT_ONCE)
                sums = _sums_of(*numbers.held(part.column("clean_text"), stop), part.num_rows, tables_)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], *sums], schema.names)

    out = rows.mapInArrow(score, schema)
    names = {"product": product_names, "issue": issue_names}
    for name in ("product", "issue"):
        out = out.withColumn("_p", _probability(F.col(f"_{name}"), F.col(f"_{name}_length"), intercepts[name]))
        out = out.withColumn("_scores", canonical_scores(F.col("_p"), labels[name], names[name]))
        out = out.withColumn(name, confidence_decision(F.col("_scores"), raw_label(F.col("_p"), labels[name]), p))
        if name == "issue":
            out = out.withColumn("multi_issue", multi_issue_record(F.col("_scores"), p))
    out = out.withColumn("topic_id", dominant_topic(F.col("_topics"))).withColumn("confidence", F.array_max("_topics"))
    return out.select(*df.columns, "product", "issue", "multi_issue", "topic_id", "confidence")
