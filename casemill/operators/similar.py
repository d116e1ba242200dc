"""Most similar documents of given texts, exact, by TF-IDF cosine.

Everything is a join on terms: terms are counted within their text, document frequencies are counted over the corpus, terms
below the threshold drop out (there is no other limit on the vocabulary), and only corpus terms that a looked-up text holds
take part in the products. The terms of the looked-up texts travel to the documents, so the documents' terms are shuffled once
only, for the lengths. Adaptive execution splits the rows of a term that very many documents hold, and products and squares are
added up per document before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from casemill.functions.arrays import counted
from casemill.operators.vectors import TERMS, with_terms
from casemill.operators.words import with_clean_text
from casemill.params import DEFAULTS, Params
from casemill.session import stage

DIGITS = 9


def term_lists(df: DataFrame, text: str, id_column: str, p: Params) -> DataFrame:
    """``id, terms``: every term of every text and how often the text holds it. Ids are unique."""
    return with_terms(with_clean_text(df, text), ngram_max=p.ngram_max).select(F.col(id_column).alias("id"), counted(F.col(TERMS)).alias(TERMS))


def term_rows(lists: DataFrame) -> DataFrame:
    """``id, term, n``."""
    return lists.select("id", F.inline(TERMS))


def term_weights(counts: DataFrame, documents: Column, p: Params = DEFAULTS) -> DataFrame:
    """``term, idf`` of the terms that at least ``min_df`` documents hold: 1 + smoothed inverse document frequency."""
    held = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= p.min_df)
    return held.select("term", (F.log((documents + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def weighted(counts: DataFrame, weights: DataFrame) -> DataFrame:
    """``id, term, w``: counts times idf, not yet scaled."""
    return counts.join(weights, "term").select("id", "term", (F.col("n") * F.col("idf")).alias("w"))


def lengths(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))


def similar_texts(
    queries: DataFrame, corpus: DataFrame, text: str, n: int = DEFAULTS.similar_rows, p: Params = DEFAULTS,
) -> DataFrame:
    """For every row ``(query_id, text)`` the ``n`` rows of ``(doc_id, text)`` with the largest cosine; ties by id. Ids may
    have any type. Texts without a common term have similarity 0, and fill up in the order of their ids."""
    counts = term_rows(stage(term_lists(corpus, text, "doc_id", p), "similar-terms"))
    documents = corpus.agg(F.count(F.lit(1))).scalar()
    weights = stage(term_weights(counts, documents, p), "similar-weights")
    asked = weighted(term_rows(term_lists(queries, text, "query_id", p)), weights)
    asked = stage(asked.join(weights, "term").withColumn("v", F.col("w") * F.col("idf")), "similar-texts")
    asked_lengths = lengths(asked).select(F.col("id").alias("query_id"), F.col("length").alias("_q"))
    products = counts.join(asked.select(F.col("id").alias("query_id"), "term", "v"), "term")
    dots = products.groupBy("query_id", F.col("id").alias("doc_id")).agg(F.sum(F.col("n") * F.col("v")).alias("dot"))
    theirs = stage(lengths(weighted(counts, weights)).withColumnRenamed("id", "doc_id"), "similar-lengths")
    scored = dots.join(theirs, "doc_id").join(asked_lengths, "query_id").select(
        "query_id", "doc_id", F.round(F.col("dot") / (F.col("length") * F.col("_q")), DIGITS).alias("similarity"))
    by_score = W.partitionBy("query_id").orderBy(F.desc("similarity"), F.asc("doc_id"))
    best = scored.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= n).drop("rank")
    # the n smallest ids, as candidates with similarity 0
    first = corpus.select("doc_id").orderBy("doc_id").limit(n)
    ids = first.agg(F.array_sort(F.collect_list("doc_id"))).scalar()
    filler = queries.select("query_id", F.explode(ids).alias("doc_id"), F.lit(0.0).alias("similarity"))
    both = best.unionByName(filler).groupBy("query_id", "doc_id").agg(F.max("similarity").alias("similarity"))
    ranked = both.withColumn("rank", F.row_number().over(by_score))
    return ranked.filter(F.col("rank") <= n)
