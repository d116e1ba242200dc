"""Evaluation of a predictions table: true label, predicted label, and optionally probabilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casemill.functions.arrays import let
from casemill.functions.text import shared_words
from casemill.operators.counts import ranked
from casemill.params import DEFAULTS, Params
from casemill.session import stage

# Explanations of a confused pair.
SAME_WORDING = (
    "' because the category labels themselves share most of their wording (",
    "); these may be near-duplicate categories from different taxonomy eras rather than truly distinct complaint "
    "types -- check the taxonomy for whether they should be merged.",
)
OTHER_WORDING = (
    "'. These categories don't share obvious wording, so the confusion is more likely driven by overlapping "
    "complaint narrative vocabulary (e.g. both categories are commonly described using similar consumer language) "
    "rather than a labeling artifact. Recommend inspecting misclassified examples directly once raw text is available."
)


def confusion(df: DataFrame, true: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """Rows per pair of labels that occurs. Everything below starts from this small table."""
    return df.groupBy(F.col(true).alias("true_label"), F.col(pred).alias("predicted_label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(pairs: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """Dense form: one row and one column per label of the union, 0 where a pair does not occur."""
    pairs = stage(pairs, "pairs") if labels is None else pairs
    both = pairs.select("true_label", "predicted_label", "n")
    zero = F.lit(0).cast("long")
    every = pairs.select(F.explode(F.array("true_label", "predicted_label")).alias("true_label")).distinct()
    filled = both.unionByName(every.select("true_label", F.col("true_label").alias("predicted_label"), zero.alias("n")))
    return filled.groupBy("true_label").pivot("predicted_label", labels).agg(F.sum("n")).na.fill(0).orderBy("true_label")


def accuracy(pairs: DataFrame) -> DataFrame:
    hit = F.col("true_label") == F.col("predicted_label")
    return pairs.agg((F.sum(F.when(hit, F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))


def per_class(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support over the union of true and predicted labels; 0 where undefined."""
    sides = F.explode(F.array(
        F.struct(F.col("true_label").alias("label"), F.col("n").alias("t"), F.lit(0).cast("long").alias("p")),
        F.struct(F.col("predicted_label").alias("label"), F.lit(0).cast("long").alias("t"), F.col("n").alias("p")),
    ))
    hit = F.when(F.col("true_label") == F.col("predicted_label"), F.col("n")).otherwise(0)
    sums = pairs.select(sides.alias("s"), hit.alias("hit")).groupBy(F.col("s.label").alias("label")).agg(
        F.sum("s.t").alias("support"), F.sum("s.p").alias("predicted"),
        F.sum(F.when(F.col("s.t") > 0, F.col("hit")).otherwise(0)).alias("hits"),
    )
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(F.col("hits") * 2.0, F.col("predicted") + F.col("support")), F.lit(0.0))
    return sums.select("label", precision.alias("precision"), recall.alias("recall"), f1.alias("f1_score"), "support")


def averages(pairs: DataFrame) -> DataFrame:
    """Accuracy, macro averages over the label union and support-weighted F1, as one row."""
    classes = per_class(pairs)
    return classes.agg(
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("accuracy"),
        F.avg("f1_score").alias("macro_f1"),
        (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
    )


def explain_confusion(true: Column, pred: Column) -> Column:
    shared, overlap = shared_words(true, pred)
    words = F.when(F.size(shared) > 0, F.array_join(shared, ", ")).otherwise("similar phrasing")
    head = F.concat(F.lit("Model struggles to distinguish '"), true, F.lit("' from '"), pred)
    return F.when(
        overlap >= 0.5, F.concat(head, F.lit(SAME_WORDING[0]), words, F.lit(SAME_WORDING[1]))
    ).otherwise(F.concat(head, F.lit(OTHER_WORDING)))


def confused_pairs(pairs: DataFrame, k: int = 10) -> DataFrame:
    wrong = pairs.filter(F.col("true_label") != F.col("predicted_label"))
    top = ranked(wrong, "n", "true_label", "predicted_label").limit(k)
    return top.select(
        "true_label", "predicted_label", F.col("n").alias("count"),
        explain_confusion(F.col("true_label"), F.col("predicted_label")).alias("explanation"),
    )


def true_rank(probability: Column, classes: Sequence[str], true: Column) -> Column:
    """Rank of the true class among the probabilities; of equal ones the later class ranks first. Null when
    the true label is no class of the model."""
    names = F.array(*[F.lit(c) for c in classes])
    at = F.array_position(names, true).cast("int")

    def rank(q: Column) -> Column:
        def of(own: Column) -> Column:
            return F.size(F.filter(q, lambda x, i: (x > own) | ((x == own) & (i > at - 1)))) + 1

        return let(F.get(q, at - 1), of)

    return F.when(at > 0, let(probability, rank))


def top_k_accuracy(
    df: DataFrame, probability: str, classes: Sequence[str], true: str = "y_true", p: Params = DEFAULTS,
) -> DataFrame:
    """Share of rows whose true label is among the k most probable classes; k is cut to the class count."""
    rank = true_rank(F.col(probability), classes, F.col(true))
    ks = [min(k, len(classes)) for k in p.top_k_values]
    scores = df.select(rank.alias("r")).agg(
        *[F.avg(F.coalesce(F.col("r") <= k, F.lit(False)).cast("double")).alias(str(v))
          for v, k in zip(p.top_k_values, ks)]
    )
    return scores.unpivot([], [str(v) for v in p.top_k_values], "k", "accuracy").select(
        F.col("k").cast("int").alias("k"), "accuracy"
    )
