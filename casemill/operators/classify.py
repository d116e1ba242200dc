"""Text classification and topic models on Spark ML."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casemill.functions import text as text_functions
from casemill.operators import evaluate, lda
from casemill.operators.predictions import canonical_scores, confidence_decision, multi_issue_record, raw_label
from casemill.operators.sampling import keep_frequent, stratified_split
from casemill.operators.topics import document_topics
from casemill.operators.vectors import COUNTS, FEATURES, TERMS, WEIGHTED, apply_model, fit_tfidf, fit_tfidfs, fit_vocabulary, term_numbers
from casemill.operators.words import with_clean_text
from casemill.params import DEFAULTS, Params
from casemill.session import stage, unstage


@dataclass(frozen=True)
class Candidate:
    """One point of the tuning grid."""
    c: float = 1.0
    balanced: bool = False
    vocabulary: int = DEFAULTS.vocabulary


# The tuning grid.
GRID = (
    Candidate(0.5), Candidate(1.0), Candidate(2.0), Candidate(1.0, True), Candidate(2.0, True),
    Candidate(1.0, False, 30_000),
)


@dataclass(frozen=True)
class Classifier:
    model: PipelineModel
    classes: list[str]
    test: DataFrame

    def predict(self, df: DataFrame) -> DataFrame:
        """Probabilities (array in class order) and the predicted label for rows with ``clean_text``, or with terms
        made before."""
        out = apply_model(self.model, df).withColumn("probability", vector_to_array("probability"))
        return out.drop(*(() if TERMS in df.columns else (TERMS,)), COUNTS, WEIGHTED, FEATURES, "rawPrediction", "prediction", "_y")


def text_rows(df: DataFrame, narrative: str, drop_empty: bool = False) -> DataFrame:
    """All rows with cleaned text."""
    return with_clean_text(df, narrative, drop_empty)


def labelled(df: DataFrame, target: str, canonical: Callable[[Column], Column] | None = None) -> DataFrame:
    """The target as ``label`` and its original as ``{target}_raw``; rows without text or target drop out."""
    rows = df.na.drop(subset=["clean_text", target]).withColumnRenamed(target, f"{target}_raw")
    raw = F.col(f"{target}_raw")
    return rows.withColumn("label", canonical(raw) if canonical else raw)


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """Classes before and after the labels are made canonical."""
    return df.agg(
        F.count_distinct(f"{target}_raw").alias("raw_classes"), F.count_distinct("label").alias("canonical_classes")
    )


def balance(df: DataFrame) -> DataFrame:
    """``label, n, weight``: weights that give every class the same say, with a mean of 1."""
    sizes = df.filter(F.col("label").isNotNull()).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg((F.sum("n") / F.count(F.lit(1))).alias("mean")).scalar()
    return sizes.select("label", "n", (total / F.col("n")).alias("weight"))


def _prepare(df: DataFrame, id_column: str, p: Params) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of all labelled rows. Both are stored, because fitting reads them many times
    and the split should not be worked out again each time; only the split stays."""
    rows = keep_frequent(df, "label", p.min_class_rows)
    rows = stage(rows.select(id_column, "label", "clean_text"), "labelled")
    if rows.select("label").distinct().limit(2).count() < 2:
        raise ValueError("Not enough classes remain to train a classifier")
    train, test = stratified_split(rows, "label", id_column, seed=p.seed)
    parts = train.withColumn("_test", F.lit(False)).unionByName(test.withColumn("_test", F.lit(True)))
    parts = stage(parts, "training")
    unstage(rows)
    return parts.filter(~F.col("_test")).drop("_test"), parts.filter("_test").drop("_test")


def _features(train: DataFrame, tfidf: PipelineModel) -> DataFrame:
    """The training rows as vectors, stored: a fit goes over them twice before it holds them."""
    return stage(apply_model(tfidf, train).select(FEATURES, "label"), "features")


def _fit(features: DataFrame, tfidf: PipelineModel, p: Params, candidate: Candidate, rows: int) -> tuple[PipelineModel, list[str]]:
    indexer = StringIndexer(inputCol="label", outputCol="_y", stringOrderType="alphabetAsc").fit(features)
    data = indexer.transform(features)
    estimator = LogisticRegression(
        featuresCol=FEATURES, labelCol="_y", family="multinomial", standardization=False,
        regParam=1.0 / (candidate.c * rows), maxIter=p.max_iter, tol=p.tolerance,
    )
    if candidate.balanced:
        data = data.join(balance(features).select("label", "weight"), "label")
        estimator = estimator.setWeightCol("weight")
    names = IndexToString(inputCol="prediction", outputCol="y_pred", labels=indexer.labels)
    model = estimator.fit(data)
    if model.summary.totalIterations >= p.max_iter:
        warnings.warn(f"the fit was stopped after {p.max_iter} steps, before its tolerance was met", stacklevel=3)
    return PipelineModel([*tfidf.stages, model, names]), list(indexer.labels)


def train_classifier(
    df: DataFrame, target: str, id_column: str, canonical: Callable[[Column], Column] | None = None,
    p: Params = DEFAULTS, candidate: Candidate = Candidate(),
) -> Classifier:
    """Train on canonical labels; vocabulary, weights and model come from the training rows only."""
    train, test = _prepare(labelled(df, target, canonical), id_column, p)
    tfidf = fit_tfidf(train, p, candidate.vocabulary)
    features = _features(train, tfidf)
    model, classes = _fit(features, tfidf, p, candidate, train.count())
    unstage(features)
    scored = apply_model(model, test).withColumn("probability", vector_to_array("probability"))
    return Classifier(model, classes, scored.select(id_column, F.col("label").alias("y_true"), "y_pred", "probability"))


def tune_classifier(
    df: DataFrame, target: str, id_column: str, p: Params = DEFAULTS, grid: Sequence[Candidate] = GRID,
) -> tuple[Classifier, DataFrame]:
    """Every grid point on raw labels and the same split; the first of the best hold-out accuracies wins. The points do not
    depend on each other, so ``p.fits_at_once`` of them are fitted at the same time."""
    train, test = _prepare(labelled(df, target), id_column, p)
    n = train.count()
    tfidf = fit_tfidfs(train, p, sorted({g.vocabulary for g in grid}))
    features = {size: _features(train, model) for size, model in tfidf.items()}

    def point(g: Candidate) -> tuple[Classifier, float | None]:
        model, classes = _fit(features[g.vocabulary], tfidf[g.vocabulary], p, g, n)
        scored = apply_model(model, test).withColumn("probability", vector_to_array("probability"))
        scored = scored.select(id_column, F.col("label").alias("y_true"), "y_pred", "probability")
        return Classifier(model, classes, scored), evaluate.accuracy(evaluate.confusion(scored)).first()["accuracy"]

    with ThreadPoolExecutor(p.fits_at_once) as pool:
        points = list(pool.map(inheritable_thread_target(df.sparkSession)(point), grid))
    for stored in features.values():
        unstage(stored)
    best, best_accuracy, report = None, -1.0, []
    for g, (model, accuracy) in zip(grid, points):
        report.append((g.c, g.balanced, g.vocabulary, accuracy))
        if accuracy is not None and accuracy > best_accuracy:
            best, best_accuracy = model, accuracy
    schema = "c double, balanced boolean, vocabulary int, accuracy double"
    return best, df.sparkSession.createDataFrame(report, schema)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def save_classifier(classifier: Classifier, path: str) -> None:
    """The model, its classes in order and its test predictions."""
    folder = path.rstrip("/")
    save_model(classifier.model, f"{folder}/model")
    spark = classifier.test.sparkSession
    spark.createDataFrame(list(enumerate(classifier.classes)), "position int, label string").write.mode("overwrite").parquet(f"{folder}/classes")
    classifier.test.write.mode("overwrite").parquet(f"{folder}/test")


def load_classifier(spark: SparkSession, path: str) -> Classifier:
    folder = path.rstrip("/")
    classes = [r["label"] for r in spark.read.parquet(f"{folder}/classes").orderBy("position").collect()]
    return Classifier(PipelineModel.load(f"{folder}/model"), classes, spark.read.parquet(f"{folder}/test"))


def score_texts(classifier: Classifier, df: DataFrame, canonical: dict[str, str], p: Params = DEFAULTS) -> DataFrame:
    """Prediction record and multi-issue record for rows with ``clean_text``; rows whose text is empty drop out."""
    scored = classifier.predict(df.filter(F.length("clean_text") > 0))
    probability = F.col("probability")
    scored = scored.withColumn("_scores", canonical_scores(probability, classifier.classes, canonical))
    record = confidence_decision(F.col("_scores"), raw_label(probability, classifier.classes), p)
    return scored.withColumn("prediction", record).withColumn(
        "multi_issue", multi_issue_record(F.col("_scores"), p)
    ).drop("_scores", "probability", "y_pred")


@dataclass(frozen=True)
class TopicModel:
    """The terms, their weights in each topic (topics x terms), the prior of the topics, and the strongest words of each."""
    terms: list[str]
    weights: np.ndarray
    prior: np.ndarray
    words: DataFrame

    def distribution(self, df: DataFrame) -> DataFrame:
        """Topic weights (array) for rows with ``clean_text``; zeros for a text without a known term."""
        found = lda.Topics(self.terms, self.weights, self.prior, text_functions.STOP_WORDS)
        sent = df.sparkSession.sparkContext.broadcast(found)
        weights = F.arrow_udf(lambda texts: sent.value.shares(texts), "array<double>")
        return df.drop(TERMS).withColumn("topics", weights(F.col("clean_text")))

    def predict(self, df: DataFrame) -> DataFrame:
        return document_topics(self.distribution(df), "topics", self.words)


def train_topics(df: DataFrame, p: Params = DEFAULTS, stop_words: Sequence[str] = text_functions.STOP_WORDS) -> TopicModel:
    """Latent topics of rows with ``clean_text``, with the strongest words of each."""
    texts = df.select("clean_text")
    terms = fit_vocabulary(texts, p.topic_vocabulary, p.topic_min_df, ngram_max=p.ngram_max, stop_words=stop_words).vocabulary
    counts = stage(term_numbers(texts, terms, stop_words=stop_words), "topic-counts")
    weights, prior = lda.fit_topics(counts, len(terms), p.topics, p.seed)
    unstage(counts)
    strongest = np.argsort(-weights, axis=1, kind="stable")[:, :p.topic_words]
    rows = [(t, [terms[i] for i in found]) for t, found in enumerate(strongest)]
    return TopicModel(list(terms), weights, prior, df.sparkSession.createDataFrame(rows, "topic_id int, topic_words array<string>"))


def save_topics(topics: TopicModel, path: str) -> None:
    """The model and the words of each topic."""
    folder, spark = path.rstrip("/"), topics.words.sparkSession
    rows = [(i, t, w.tolist()) for i, (t, w) in enumerate(zip(topics.terms, topics.weights.T))]
    spark.createDataFrame(rows, "position int, term string, weights array<double>").write.mode("overwrite").parquet(f"{folder}/terms")
    spark.createDataFrame(list(enumerate(topics.prior.tolist())), "topic_id int, prior double").write.mode("overwrite").parquet(f"{folder}/prior")
    topics.words.write.mode("overwrite").parquet(f"{folder}/words")


def load_topics(spark: SparkSession, path: str) -> TopicModel:
    folder = path.rstrip("/")
    rows = spark.read.parquet(f"{folder}/terms").orderBy("position").collect()
    prior = [r["prior"] for r in spark.read.parquet(f"{folder}/prior").orderBy("topic_id").collect()]
    weights = np.array([r["weights"] for r in rows]).T
    return TopicModel([r["term"] for r in rows], weights, np.array(prior), spark.read.parquet(f"{folder}/words"))


def analyze_texts(
    df: DataFrame, product: Classifier, issue: Classifier, topics: TopicModel, product_names: dict[str, str],
    issue_names: dict[str, str], p: Params = DEFAULTS,
) -> DataFrame:
    """Product record, issue record with extra candidates, and topic of every text, as one projection."""
    out = score_texts(product, df, product_names, p).withColumnRenamed("prediction", "product").drop("multi_issue")
    out = score_texts(issue, out, issue_names, p).withColumnRenamed("prediction", "issue")
    return topics.predict(out)
