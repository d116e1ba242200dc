import math
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casemill.operators import classify, evaluate, lda, predictions, sampling, similar, tables, taxonomy, topics, vectors, words
from casemill.params import Params
from casemill.sources import reports


def test_taxonomy(spark):
    df = spark.createDataFrame([("Credit reporting ",), ("Closing your account",), ("new label",), (None,)], "x string")
    got = [r[0] for r in df.select(taxonomy.canonical_product(F.col("x"))).collect()]
    assert got == ["Credit Reporting", "Closing your account", "new label", None]
    assert df.select(taxonomy.canonical_issue(F.col("x"))).collect()[1][0] == "Closing an Account"
    rows = taxonomy.report(spark, "Issue").collect()
    assert len(rows) == 10 and all(r["raw_label_count"] == len(r["raw_labels"]) for r in rows)
    assert {r["confidence"] for r in rows} == {"high", "medium"}


def test_taxonomy_audit(spark):
    # Test-set supports of a published product classifier; six unmapped products complete the 18 classes.
    support = {
        "Bank account or service": 78, "Checking or savings account": 951, "Credit card": 646,
        "Credit card or prepaid card": 592, "Prepaid card": 57, "Credit reporting": 172,
        "Credit reporting or other personal consumer reports": 8752,
        "Credit reporting, credit repair services, or other personal consumer reports": 4244, "Payday loan": 11,
        "Payday loan, title loan, or personal loan": 89, "Payday loan, title loan, personal loan, or advance loan": 85,
        "Consumer Loan": 49, "a": 9, "b": 100, "c": 100, "d": 100, "e": 100, "f": 100,
    }
    df = spark.createDataFrame(list(support.items()), "label string, support long")
    assert tuple(taxonomy.audit(df, taxonomy.canonical_product).first()) == (18, 11, 7, 3, 2, 4)
    merged = {r["canonical_label"]: r for r in taxonomy.merged_groups(df, taxonomy.canonical_product).collect()}
    assert merged["Credit Reporting"]["combined_support"] == 13168
    assert merged["Payday / Title / Personal Loan"]["combined_support"] == 185


def record(spark, probabilities, p=Params()):
    classes = ["Closing an account", "Closing your account", "b", "c"]
    names = {"Closing an account": "Closing an Account", "Closing your account": "Closing an Account"}
    df = spark.createDataFrame([(probabilities,)], "p array<double>")
    scores = predictions.canonical_scores(F.col("p"), classes, names)
    raw = predictions.raw_label(F.col("p"), classes)
    return df.select(predictions.confidence_decision(scores, raw, p).alias("d"),
                     predictions.multi_issue_record(scores, p).alias("m")).first()


def test_confidence_decision_is_on_unrounded_canonical_scores(spark):
    row = record(spark, [0.25, 0.29996, 0.35004, 0.1])
    assert row["d"]["label"] == "Closing an Account" and row["d"]["raw_label"] == "b"
    assert row["d"]["confidence"] == 0.55 and row["d"]["decision"] == "HUMAN_REVIEW"
    assert [a["label"] for a in row["d"]["alternatives"]] == ["b", "c"]
    assert record(spark, [0.3, 0.25, 0.35, 0.1])["d"]["decision"] == "AUTO_ACCEPT"


def test_multi_issue(spark):
    row = record(spark, [0.2, 0.3, 0.4, 0.1])["m"]
    assert row["primary_issue"]["label"] == "Closing an Account"
    assert [c["label"] for c in row["additional_candidate_issues"]] == ["b"]
    zero = record(spark, [0.0, 0.0, 0.0, 0.0])["m"]
    assert zero["primary_issue"]["confidence"] == 0.0 and zero["additional_candidate_issues"] == []


def test_evaluation(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c d", "c d e"), ("a", "b")], "y_true string, y_pred string")
    pairs = evaluate.confusion(df)
    assert evaluate.accuracy(pairs).first()[0] == pytest.approx(0.4)
    rows = {r["label"]: r for r in evaluate.per_class(pairs).collect()}
    assert rows["a"]["precision"] == 1.0 and rows["a"]["recall"] == pytest.approx(1 / 3)
    assert rows["c d e"]["support"] == 0 and rows["c d e"]["f1_score"] == 0.0
    assert evaluate.averages(pairs).first()["macro_precision"] == pytest.approx((1 + 1 / 3) / 4)
    top = evaluate.confused_pairs(pairs).collect()
    assert (top[0]["true_label"], top[0]["count"]) == ("a", 2) and "narrative vocabulary" in top[0]["explanation"]
    assert "share most of their wording (c, d)" in top[1]["explanation"]
    dense = evaluate.confusion_matrix(pairs).collect()
    assert len(dense) == 4 and dense[0]["b"] == 2 and dense[3]["a"] == 0


def test_top_k_is_cut_to_the_class_count(spark):
    df = spark.createDataFrame([("a", [0.5, 0.3, 0.2]), ("c", [0.5, 0.3, 0.2]), ("z", [0.5, 0.3, 0.2])], "y_true string, p array<double>")
    got = {r["k"]: r["accuracy"] for r in evaluate.top_k_accuracy(df, "p", ["a", "b", "c"]).collect()}
    assert got == pytest.approx({1: 1 / 3, 3: 2 / 3, 5: 2 / 3})


def test_topics(spark):
    df = spark.createDataFrame([(0,), (0,), (2,)], "t int")
    shares = {r["topic_id"]: r["share"] for r in topics.prevalence(df, "t", 4).collect()}
    assert shares == pytest.approx({0: 2 / 3, 1: 0.0, 2: 1 / 3, 3: 0.0}) and sum(shares.values()) == pytest.approx(1)
    assert topics.prevalence(df.filter("false"), "t", 4).count() == 0
    now = spark.createDataFrame([(1, 0.53), (2, 0.02)], "topic_id int, share double")
    then = spark.createDataFrame([(1, 0.5), (3, 0.9)], "topic_id int, share double")
    assert [r["topic_id"] for r in topics.emerging(now, then, 0.02).collect()] == [1, 2]
    words_of = spark.createDataFrame([(1, ["w"]), (2, ["v"])], "topic_id int, topic_words array<string>")
    names = spark.createDataFrame([(1, "One")], "topic_id int, label string")
    report = topics.discovery_report(words_of, now, then, names)
    assert {r["topic_id"]: r["label"] for r in report["topics"].collect()} == {1: "One", 2: "Topic 2"}
    assert report["recurring_themes"].first()["topic_id"] == 1 and set(report) == {"topics", "recurring_themes", "emerging_issues"}


def test_samples_are_exact_and_reproducible_with_a_hot_stratum(spark):
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("c"))
    first = sampling.sample_rows(df, 1234, "id")
    assert first.count() == 1234
    assert {r[0] for r in first.select("id").collect()} == {r[0] for r in sampling.sample_rows(df, 1234, "id").select("id").collect()}
    assert sampling.sample_rows(df, 10_000, "id").count() == 9000
    train, test = sampling.stratified_split(df, "c", "id")
    assert train.count() + test.count() == 9000 and train.join(test, "id").count() == 0
    total = {r["c"]: r["count"] for r in df.groupBy("c").count().collect()}
    for r in test.groupBy("c").count().collect():
        assert r["count"] == round(total[r["c"]] * 0.2)
    assert sampling.keep_frequent(df, "c", 1000).select("c").distinct().collect()[0][0] == "hot"


def test_similar_is_exact_with_copies(spark):
    rng = np.random.default_rng(7)
    vocabulary = [f"{a}{b}" for a in "bcdfgklm" for b in ("ar", "ol", "it", "ep")]
    docs = [(i, " ".join(rng.choice(vocabulary, 12))) for i in range(200)]
    docs += [(1000 + i, docs[0][1]) for i in range(100)]  # a third are copies of one
    queries = [(i, " ".join(rng.choice(vocabulary, 6))) for i in range(300)] + [(999, "zzzz")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    qs = spark.createDataFrame(queries, "query_id long, text string")
    p = Params(min_df=1, ngram_max=1)
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["similarity"]) for r in similar.similar_texts(qs, df, "text", 5, p).collect()}

    def weights(text, idf):
        found = [w for w in text.split() if w in idf]
        raw = {w: found.count(w) * idf[w] for w in set(found)}
        length = math.sqrt(sum(v * v for v in raw.values())) or 1.0
        return {w: v / length for w, v in raw.items()}

    idf = {w: math.log((1 + len(docs)) / (1 + sum(w in t.split() for _, t in docs))) + 1 for w in vocabulary}
    vectors = [(i, weights(t, idf)) for i, t in docs]
    for q, text in queries:
        v = weights(text, idf)
        scored = sorted(((-round(sum(v.get(w, 0) * x for w, x in d.items()), 9), i) for i, d in vectors))[:5]
        for rank, (score, doc) in enumerate(scored, 1):
            assert got[q, rank][0] == doc and got[q, rank][1] == pytest.approx(-score, abs=1e-9)


@pytest.fixture(scope="module")
def letters(spark):
    kinds = {"Credit card": "card charge fee", "Prepaid card": "card charge fee", "Mortgage": "house loan bank", "Debt collection": "call agent debt"}
    rows = [(i, f"{kinds[k]} number {'word' if i % 2 else 'other'} {chr(97 + i % 26) * 3}", k)
            for i, k in enumerate(list(kinds) * 40)]
    return spark.createDataFrame(rows, "id long, narrative string, Product string")


def test_classifier_learns_canonical_labels(spark, letters, tmp_path):
    p = Params(min_class_rows=10, max_iter=30)
    texts = classify.text_rows(letters, "narrative")
    rows = classify.labelled(texts, "Product", taxonomy.canonical_product)
    assert tuple(classify.class_counts(rows, "Product").first()) == (4, 3)
    model = classify.train_classifier(texts, "Product", "id", taxonomy.canonical_product, p)
    assert model.classes == ["Credit Card / Prepaid Card", "Debt collection", "Mortgage"]
    assert evaluate.accuracy(evaluate.confusion(model.test)).first()[0] == 1.0
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 for r in model.test.collect())
    classify.save_model(model.model, str(tmp_path / "m"))
    scored = classify.score_texts(model, texts.unionByName(texts.limit(1).withColumn("clean_text", F.lit(""))), {}, p)
    assert scored.count() == letters.count()
    for r in scored.select("prediction").collect():
        accepted = r["prediction"]["decision"] == "AUTO_ACCEPT"
        assert accepted == (r["prediction"]["confidence"] >= 0.55)
    topics_model = classify.train_topics(texts, Params(topics=2, topic_min_df=2, topic_words=4))
    everything = classify.analyze_texts(texts, model, model, topics_model, {}, {}, p)
    assert {"product", "issue", "multi_issue", "topic_id", "topic_words", "confidence"} <= set(everything.columns)
    assert everything.count() == letters.count()


def test_grid_takes_the_first_best(letters):
    p = Params(min_class_rows=10, max_iter=10)
    texts = classify.text_rows(letters, "narrative", drop_empty=True)
    grid = (classify.Candidate(1.0), classify.Candidate(2.0, True))
    best, table = classify.tune_classifier(texts, "Product", "id", p, grid)
    assert table.count() == 2 and len(best.classes) == 4


def test_vocabularies_of_a_grid_are_fitted_in_one_go(letters, monkeypatch):
    calls, fit = [], vectors.fit_vocabulary
    monkeypatch.setattr(vectors, "fit_vocabulary", lambda *a, **k: calls.append(a) or fit(*a, **k))
    p = Params(min_df=2)
    rows = vectors.with_terms(classify.text_rows(letters, "narrative", drop_empty=True)).cache()
    both = vectors.fit_tfidfs(rows, p, [5, 12])
    assert len(calls) == 1
    for size, model in both.items():
        alone = fit(rows, size, p.min_df)
        assert model.stages[0].vocabulary == alone.vocabulary and len(alone.vocabulary) <= size
        idf = vectors.IDF(inputCol=vectors.COUNTS, outputCol="w").fit(alone.transform(rows))
        assert np.array_equal(model.stages[1].getScalingVec().toArray(), idf.idf.toArray() + 1.0)


def test_rare_classes_leave(letters):
    texts = classify.text_rows(letters, "narrative")
    with pytest.raises(ValueError, match="Not enough classes"):
        classify.train_classifier(texts, "Product", "id", None, Params(min_class_rows=1000))


def test_reports(spark, tmp_path):
    table = ("              precision    recall  f1-score   support\n\n  Credit card, or other       0.53      0.46      0.49       646\n"
             "    Mortgage       0.70      0.62      0.66       266\n    accuracy                           0.75     19987\n"
             "   macro avg       0.52      0.43      0.44     19987\nweighted avg       0.74      0.75      0.74     19987\n")
    (tmp_path / "old.txt").write_text("Best Accuracy: 0.7528\nBest Params: {'C': 2.0}\n\n" + table)
    (tmp_path / "new.txt").write_text(
        "=== t ===\n\nAccuracy:          0.8000\nMacro F1:          0.4400\nWeighted F1:       0.7400\nMacro Precision:   0.5000\n"
        "Macro Recall:      0.4000\nTop-1 Accuracy:    0.8000\nTop-3 Accuracy:    0.9000\n\n"
        "  True='a b'  ->  Predicted='c'  (x12)\n      Because.\n\n" + table)
    rows = reports.class_rows(spark, str(tmp_path)).collect()
    assert len(rows) == 4 and {r["label"] for r in rows} == {"Credit card, or other", "Mortgage"}
    heads = {r["format"]: r for r in reports.headlines(spark, str(tmp_path)).collect()}
    assert heads["legacy"]["accuracy"] == 0.7528 and heads["legacy"]["macro_f1"] is None
    assert heads["new"]["accuracy"] == 0.8 and heads["new"]["top_k_accuracy"] == {1: 0.8, 3: 0.9}
    pair = reports.confused_pairs(spark, str(tmp_path)).first()
    assert (pair["true_label"], pair["predicted_label"], pair["count"], pair["explanation"]) == ("a b", "c", 12, "Because.")


def test_word_counts(spark):
    df = spark.createDataFrame([("The loan, the LOAN and bank.",), (None,)], "t string")
    assert [tuple(r) for r in words.top_words(df, "t").collect()] == [("loan", 2), ("bank", 1)]
    assert [tuple(r) for r in words.top_ngrams(df, "t", 2).collect()] == [("loan bank", 1), ("loan loan", 1)]
    assert words.top_words(df.filter("false"), "t").count() == 0


@pytest.mark.parametrize("limit", [sampling.SMALL_TABLE, 0])
def test_strata_of_any_type(spark, monkeypatch, limit):
    monkeypatch.setattr(sampling, "SMALL_TABLE", limit)
    n = F.col("id")
    strata = {
        "boolean": n % 2 == 0, "timestamp": F.timestamp_micros(n % 3 * 1_000_001 + 7), "decimal": (n % 4 / 8).cast("decimal(12,3)"),
        "binary": F.unhex(F.lpad(F.hex(n % 3), 2, "0")), "double": F.when(n % 4 == 0, F.lit(float("nan"))).when(n % 4 == 1, -0.0).when(n % 4 == 2, 0.0).otherwise(1e300),
        "null or text": F.when(n % 3 > 0, F.concat(F.lit("="), (n % 3).cast("string"))), "pair": F.struct((n % 2).alias("a"), F.lit(None).cast("string").alias("b")),
        "many": F.concat(F.lit("s"), (n % 10_000).cast("string")) if limit else F.lit("one"),
    }
    for name, value in strata.items():
        rows = 100_000 if name == "many" and limit else 1000
        df = spark.range(rows).select("id", value.alias("a stratum"))
        train, test = (x.groupBy("a stratum").count() for x in sampling.stratified_split(df, "a stratum", "id"))
        total = {str(r[0]): r[1] for r in df.groupBy("a stratum").count().collect()}
        assert {str(r[0]): r[1] for r in test.collect()} == {k: round(v * 0.2) for k, v in total.items()}, name
        assert {str(r[0]): r[1] for r in train.collect()} == {k: v - round(v * 0.2) for k, v in total.items()}, name
        if name in ("boolean", "binary", "double"):
            kept = sampling.keep_frequent(df, "a stratum", 300)
            assert kept.columns == df.columns and kept.count() == sum(v for v in total.values() if v >= 300)


SCORES = """
WITH met AS (SELECT c.id, c.n * t.idf AS w, t.weights FROM counts c JOIN terms t USING (term)),
per AS (SELECT id, sqrt(sum(w * w)) AS length FROM met GROUP BY id),
sums AS (SELECT id, k, sum(w * weights[k + 1]) AS s FROM met, (SELECT position AS k FROM classes) GROUP BY id, k),
margins AS (SELECT t.id, label, intercept + coalesce(s / length, 0) AS m FROM texts t CROSS JOIN classes
    LEFT JOIN sums ON sums.id = t.id AND k = position LEFT JOIN per ON per.id = t.id),
shares AS (SELECT id, label, exp(m) / sum(exp(m)) OVER (PARTITION BY id) AS p FROM margins)
SELECT id, max_by(label, p) AS label, max(p) AS p FROM shares GROUP BY id
"""


def test_models_as_tables(spark, letters, tmp_path):
    import duckdb

    p = Params(min_class_rows=10, max_iter=30, topics=3, topic_min_df=2, topic_words=4)
    texts = classify.text_rows(letters, "narrative").withColumn("Issue", F.when(F.col("id") % 2 == 0, "other").otherwise("word"))
    more = texts.limit(1).withColumn("clean_text", F.lit("qqqq zzzz")).withColumn("id", F.lit(-1).cast("long"))
    texts = texts.unionByName(more)
    product = classify.train_classifier(texts.where("id >= 0"), "Product", "id", taxonomy.canonical_product, p)
    issue = classify.train_classifier(texts.where("id >= 0"), "Issue", "id", None, p)
    model = classify.train_topics(texts, p)
    tables.save_tables(tables.Analysis(tables.linear_table(product), tables.linear_table(issue), tables.topic_table(model)), str(tmp_path / "t"))
    models = tables.load_tables(spark, str(tmp_path / "t"))
    assert models.product.labels == product.classes
    found = {r["id"]: r for r in tables.analyzed(texts, "id", models, {}, {}, p).collect()}
    assert len(found) == texts.count() and -1 in found
    for name, fitted in (("product", product), ("issue", issue)):
        classify.save_classifier(fitted, str(tmp_path / name))
        for again in (fitted, classify.load_classifier(spark, str(tmp_path / name))):
            for r in classify.score_texts(again, texts, {}, p).collect():
                mine = found[r["id"]][name]
                assert (mine["label"], mine["decision"], mine["raw_label"]) == (r["prediction"]["label"], r["prediction"]["decision"], r["prediction"]["raw_label"])
                assert mine["confidence"] == pytest.approx(r["prediction"]["confidence"], abs=1e-4)
    counts = tables.term_counts(texts, "id", p)
    counts.write.parquet(str(tmp_path / "counts"))
    texts.select("id").write.parquet(str(tmp_path / "texts"))
    con = duckdb.connect()
    for view, path in (("counts", "counts"), ("texts", "texts"), ("terms", "t/product-terms"), ("classes", "t/product-classes")):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{tmp_path}/{path}/*.parquet'")
    for i, label, share in con.execute(SCORES).fetchall():
        assert found[i]["product"]["confidence"] == pytest.approx(share, abs=1e-4) and (share < 0.5 or found[i]["product"]["label"] == label)
    weights = {r["term"]: np.array(r["weights"]) for r in models.topics.collect()}
    held = {}
    for r in counts.collect():
        held.setdefault(r["id"], []).append((r["term"], r["n"]))
    for i, row in found.items():
        theta = np.full(3, 1 / 3)
        for _ in range(tables.TOPIC_STEPS):
            new = np.full(3, 1 / 3)
            for term, n in held.get(i, []):
                if term in weights:
                    new = new + n * theta * weights[term] / (theta * weights[term]).sum()
            theta = new / new.sum()
        assert row["confidence"] == pytest.approx(theta.max(), abs=1e-9)
    classify.save_topics(model, str(tmp_path / "topics"))
    again = classify.load_topics(spark, str(tmp_path / "topics"))
    assert sorted(map(tuple, ((r["id"], r["topic_id"]) for r in again.predict(texts).collect()))) == sorted((r["id"], r["topic_id"]) for r in model.predict(texts).collect())


def test_vocabulary_is_cut_by_frequency_then_term(spark):
    rows = [(i, f"{'aa ' * (i % 3)} bb cc {'dd' if i % 2 else 'ee'}") for i in range(12)]
    df = spark.createDataFrame(rows, "id long, clean_text string")
    p = Params(min_df=2, ngram_max=1)
    counts = tables.term_counts(df, "id", p)
    for size, want in ((1, {"aa"}), (2, {"aa", "bb"}), (3, {"aa", "bb", "cc"}), (4, {"aa", "bb", "cc", "dd"}), (9, {"aa", "bb", "cc", "dd", "ee"}), (0, set())):
        assert {r["term"] for r in tables.vocabulary(counts, F.lit(12), size, p).collect()} == want
    squares = tables.weights(counts, tables.vocabulary(counts, F.lit(12), 3, p)).groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("s"))
    assert all(r["s"] == pytest.approx(1) for r in squares.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_terms_are_counted_within_their_text(spark):
    df = spark.createDataFrame([(1, "bb aa bb"), (2, ""), (3, None), (4, "aa")], "id long, clean_text string")
    counts = tables.term_counts(df, "id", Params(ngram_max=2))
    assert sorted(map(tuple, counts.collect())) == [(1, "aa", 1), (1, "aa bb", 1), (1, "bb", 2), (1, "bb aa", 1), (4, "aa", 1)]
    assert "Exchange" not in plan(counts)
    # only terms of the vocabulary are shuffled, and once
    found = tables.weights(counts, spark.createDataFrame([("aa", 1.0), ("bb", 2.0)], "term string, idf double"))
    assert plan(found).count("Scan ExistingRDD") == 1


def test_fitted_vocabulary_is_cut_by_frequency_then_term(spark):
    df = spark.createDataFrame([([f"t{i:02}" for i in range(k, 40)],) for k in (0, 20, 20)], "terms array<string>")
    found = vectors.fit_vocabulary(df, 25, 1)
    assert found.vocabulary == [f"t{i}" for i in range(20, 40)] + [f"t0{i}" for i in range(5)]
    row = found.transform(spark.createDataFrame([(["t39", "t39", "t19"],)], "terms array<string>")).first()
    assert row["term_counts"].toArray().tolist() == [2.0 if i == 19 else 0.0 for i in range(25)]
    with pytest.raises(ValueError):
        vectors.fit_vocabulary(df, 25, 4)


ODD_TEXTS = ["aa bb aa bb cc", None, "", "a b c", "aa the bb", "the", "bb", " aa  bb ", "cc aa bb aa bb cc dd", "aa" * 40, "dd aa bb cc aa bb cc", "aa bb"]


def test_terms_are_counted_from_the_text(spark, monkeypatch):
    """What is counted without making terms is what the terms of each text give; parts of any size give the same sums."""
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_TEXTS)], "id long, clean_text string")
    stop = pa.array(vectors.text.STOP_WORDS, pa.string())
    for n in (1, 2, 3):
        found = vectors.counted_terms(texts.repartition(3), ngram_max=n).groupBy("term").agg(F.sum("df"), F.sum("tf"))
        terms = [r["terms"] for r in vectors.with_terms(texts.na.drop(), ngram_max=n).collect()]
        wanted = {t: (sum(t in x for x in terms), sum(x.count(t) for x in terms)) for x in terms for t in x}
        assert {r[0]: (r[1], r[2]) for r in found.collect()} == wanted
        for size in (1, 20):
            monkeypatch.setattr(vectors, "BYTES_AT_ONCE", size)
            parts, sums = list(vectors._parts(pa.array(ODD_TEXTS))), {}
            assert len(parts) > 1 and pa.concat_arrays(parts).to_pylist() == ODD_TEXTS
            for r in [r for part in parts for b in vectors._counted_terms(part, n, stop) for r in b.to_pylist()]:
                df, tf = sums.get(r["term"], (0, 0))
                sums[r["term"]] = df + r["df"], tf + r["tf"]
            assert sums == wanted
    assert [len(p) for p in vectors._parts(pa.array([], pa.string()))] == [0]


def test_texts_become_the_vectors_of_their_terms(spark):
    """Also phrases whose beginning is no term, terms no text holds, and texts without a known term."""
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_TEXTS) if t is not None], "id long, clean_text string")
    for vocabulary in (["bb", "aa bb", "cc aa bb", "zz", "aa", "bb dd"], ["dd"], ["bb cc aa bb"], ["zz yy"]):
        model = vectors.CountVectorizerModel.from_vocabulary(vocabulary, inputCol=vectors.TERMS, outputCol=vectors.COUNTS)
        wanted = {r["id"]: r[vectors.COUNTS] for r in model.transform(vectors.with_terms(texts, ngram_max=4)).collect()}
        assert {r["id"]: r[vectors.COUNTS] for r in vectors.with_counts(texts, model).collect()} == wanted
    null = vectors.with_counts(spark.createDataFrame([(None,)], "clean_text string"), model).first()
    assert null[vectors.COUNTS].numNonzeros() == 0


def test_classifier_makes_no_terms_for_fitting_or_scoring(letters, monkeypatch):
    stored, stage = {}, classify.stage
    monkeypatch.setattr(classify, "stage", lambda df, name: stored.setdefault(name, stage(df, name)))
    p, texts = Params(min_class_rows=10, max_iter=10), classify.text_rows(letters, "narrative")
    model = classify.train_classifier(texts, "Product", "id", None, p)
    assert "terms" not in stored["training"].columns
    scored = model.predict(texts)
    assert "ArrowEvalPython" in plan(scored) and plan(scored).count("ArrowEvalPython") == 1
    columns = ["id", "probability", "y_pred"]
    made = model.predict(vectors.with_terms(texts)).select(columns).orderBy("id").collect()
    assert scored.select(columns).orderBy("id").collect() == made


def test_similar_texts_shuffle_the_documents_terms_once(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(similar, "stage", lambda df, name: seen.setdefault(name, df))
    docs = spark.createDataFrame([(i, f"aa bb {'cc' if i % 2 else 'dd'} aa") for i in range(6)], "doc_id long, text string")
    asked = spark.createDataFrame([(0, "aa cc")], "query_id long, text string")
    found = similar.similar_texts(asked, docs, "text", 2, Params(min_df=2))
    assert "Aggregate" not in plan(seen["similar-terms"])
    assert [(r["doc_id"], r["rank"]) for r in found.orderBy("rank").collect()] == [(1, 1), (3, 2)]


def test_texts_meet_the_models_where_they_lie(spark):
    """No term and no text is shuffled; unknown terms, empty texts and terms of one model only count as such."""
    schema = "term string, idf double, weights array<double>"
    product = tables.LinearTable(spark.createDataFrame([("aa", 2.0, [1.0, -1.0]), ("bb", 1.0, [0.0, 3.0])], schema),
                                 spark.createDataFrame([(0, "x", 0.5), (1, "y", 0.0)], "position int, label string, intercept double"))
    issue = tables.LinearTable(spark.createDataFrame([("cc", 1.0, [1.0, 0.0, 0.0])], schema),
                               spark.createDataFrame([(i, c, 0.0) for i, c in enumerate("pqr")], "position int, label string, intercept double"))
    topic_rows = spark.createDataFrame([("aa", [0.9, 0.1]), ("zz", [0.0, 0.0])], "term string, weights array<double>")
    texts = spark.createDataFrame([(1, "aa bb aa"), (2, "qq zz"), (3, ""), (4, None), (5, "cc")], "id long, clean_text string")
    found = tables.analyzed(texts, "id", tables.Analysis(product, issue, topic_rows), {}, {}, Params(ngram_max=1))
    assert "Exchange" not in plan(found)
    assert found.select("id", "product.label", F.size("multi_issue.additional_candidate_issues"), F.round("confidence", 6)).count() == 3
    rows = {r["id"]: r for r in found.collect()}
    assert set(rows) == {1, 2, 5}
    margin = (0.5 + 4 / math.sqrt(17)) - (-4 + 3) / math.sqrt(17)
    assert rows[1]["product"]["label"] == "x" and rows[1]["product"]["confidence"] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-4)
    assert rows[2]["product"]["confidence"] == pytest.approx(1 / (1 + math.exp(-0.5)), abs=1e-4) and rows[2]["confidence"] == 0.5
    assert rows[5]["issue"]["label"] == "p" and rows[5]["issue"]["confidence"] == pytest.approx(math.e / (math.e + 2), abs=1e-4)
    assert rows[1]["topic_id"] == 0 and rows[1]["confidence"] > 0.6


def rows_of(arrays):
    return list(zip(*[a.to_pylist() for a in arrays]))


def test_many_texts_are_scored_in_parts():
    known = tables._Known(pa.array(["aa", "bb"]), [(np.array([1.0, 2.0]), np.array([[1.0], [3.0]]))] * 2, np.array([[0.3, 0.7], [0.6, 0.4]]))
    terms = pa.array([["aa", "bb", "bb"], [], ["cc"], ["bb"], None, ["aa"]])
    whole = rows_of(tables._sums(terms, known))
    parts = [r for i in range(0, 6, 2) for r in rows_of(tables._sums(terms.slice(i, 2), known))]
    assert whole == parts and whole[0][0] == [13.0] and whole[0][1] == pytest.approx(math.sqrt(17))
    assert whole[2][4] == [0.5, 0.5] and whole[4][0] == [0.0]
    assert [a.type for a in tables._sums(terms.slice(2, 1), known)] == [a.type for a in tables._sums(terms, known)]


def plain_weights(term, n, beta, alpha):
    """Topic weights of one text by plain steps."""
    g = np.ones(len(alpha))
    while True:
        share = np.exp(lda.expected_log(g))
        new = share * (beta[term].T @ (n / (beta[term] @ share))) + alpha
        if np.abs(new - g).mean() <= 1e-9:
            return new
        g = new


def test_topics_are_fitted_from_numbers(spark, letters, monkeypatch):
    """Ten steps of the online rules over all texts, no text as strings of terms; weights as by plain steps."""
    stored, stage = {}, classify.stage
    monkeypatch.setattr(classify, "stage", lambda df, name: stored.setdefault(name, stage(df, name)))
    monkeypatch.setattr(classify, "unstage", lambda df: None)
    texts = classify.text_rows(letters, "narrative").unionByName(classify.text_rows(letters, "narrative").limit(1).withColumn("clean_text", F.lit("")))
    p = Params(topics=2, topic_min_df=2, topic_words=4)
    model = classify.train_topics(texts, p)
    assert set(stored) == {"topic-counts"} and stored["topic-counts"].columns == ["term", "n"]
    rows = [(np.array(r["term"]), np.array(r["n"])) for r in stored["topic-counts"].collect() if r["term"]]
    topics, alpha = np.random.default_rng(p.seed).gamma(lda.SHAPE, 1 / lda.SHAPE, (2, len(model.terms))), np.full(2, 0.5)
    for number in range(1, lda.STEPS + 1):
        beta, stats, logs = np.exp(lda.expected_log(topics)).T, np.zeros((len(model.terms), 2)), np.zeros(2)
        for term, n in rows:
            e = lda.expected_log(plain_weights(term, n, beta, alpha))
            logs += e
            stats[term] += np.outer(n / (beta[term] @ np.exp(e)), np.exp(e))
        weight = (1024 + number) ** -0.51
        topics = (1 - weight) * topics + weight * ((stats * beta).T + 0.5)
        alpha = lda._next_prior(alpha, logs / len(rows), len(rows), weight)
    assert np.allclose(model.weights, topics, rtol=0.02) and np.allclose(model.prior, alpha, rtol=0.01)
    assert [r["topic_words"][0] for r in model.words.orderBy("topic_id").collect()] == [model.terms[i] for i in model.weights.argmax(axis=1)]


def test_topics_of_texts_make_no_terms(spark, letters):
    texts = classify.text_rows(letters, "narrative").unionByName(classify.text_rows(letters, "narrative").limit(1).select(
        F.lit(-1).cast("long").alias("id"), "narrative", "Product", F.lit("qq").alias("clean_text")))
    model = classify.train_topics(texts, Params(topics=3, topic_min_df=2))
    alone = plan(model.distribution(texts.where("id >= 0").select("id", F.col("narrative").alias("clean_text"))))
    assert "ArrowEvalPython" in alone and "transform(" not in alone
    rows = model.distribution(texts).collect()
    assert len(rows) == texts.count() and all(sum(r["topics"]) == pytest.approx(1 if r["id"] >= 0 else 0) for r in rows)


def test_topic_weights_of_a_text_do_not_depend_on_its_neighbours(monkeypatch):
    assert lda.digamma(np.array([1.0, 0.01])) == pytest.approx([-0.5772156649, -100.5608854579]) and lda.trigamma(1.0) == pytest.approx(math.pi**2 / 6)
    rng = np.random.default_rng(1)
    beta, alpha = np.exp(lda.expected_log(rng.gamma(0.3, 1.0, (4, 50)) + 0.01)).T, np.array([0.25, 0.1, 0.5, 0.05])
    size = np.array([0, 1, 50, 7, 0, 20, 3])
    begin = np.concatenate([[0], np.cumsum(size)])
    term = np.concatenate([np.sort(rng.choice(50, s, replace=False)) for s in size])
    n = rng.integers(1, 9, len(term)).astype(float)
    whole = lda.topic_weights(begin, term, n, beta, alpha)
    assert np.array_equal(whole[[0, 4]], [alpha, alpha]) and np.allclose(whole.sum(axis=1), alpha.sum() + np.add.reduceat(np.append(n, 0), begin[:-1]) * (size > 0))
    for cells in (1, 30):
        monkeypatch.setattr(lda, "CELLS", cells)
        assert np.allclose(lda.topic_weights(begin, term, n, beta, alpha), whole, rtol=1e-9)
    for i in (1, 2, 3, 5, 6):
        part = slice(begin[i], begin[i + 1])
        assert np.allclose(whole[i], plain_weights(term[part], n[part], beta, alpha), atol=0.05)


def plenty(spark, n):
    odd = F.col("id") % 2 == 0
    return spark.range(n).select("id", F.when(odd, "a").otherwise("b").alias("Product"), F.when(odd, "aa cc").otherwise("bb cc").alias("clean_text"))


def test_grid_is_tuned_on_all_rows(spark):
    best, _ = classify.tune_classifier(plenty(spark, 100_100), "Product", "id", Params(max_iter=3), (classify.Candidate(1.0),))
    assert best.test.count() == 20_020


def test_classifier_is_trained_on_all_rows(spark):
    model = classify.train_classifier(plenty(spark, 300_100), "Product", "id", None, Params(max_iter=3))
    assert model.test.count() == 60_020


def test_analyzed_texts_make_no_terms(spark, letters):
    """Sums from the texts are those from their terms, also for texts that are null, empty or of unknown words."""
    known = tables._Known(pa.array(["aa", "bb", "aa bb", "cc aa bb"]), [(np.arange(1.0, 5.0), np.arange(8.0).reshape(4, 2))] * 2, np.array([[0.3, 0.7], [0.6, 0.4], [0.0, 0.0], [0.9, 0.1]]))
    texts = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "id long, clean_text string").orderBy("id")
    made = [r["terms"] for r in vectors.with_terms(texts, ngram_max=3).orderBy("id").collect()]
    numbers = vectors.Vocabulary(known.terms.to_pylist()).held(pa.array(ODD_TEXTS), pa.array(vectors.text.STOP_WORDS))
    assert rows_of(tables._sums_of(*numbers, len(ODD_TEXTS), known)) == rows_of(tables._sums(pa.array(made), known))
    schema = "term string, idf double, weights array<double>"
    linear = tables.LinearTable(spark.createDataFrame([("card", 2.0, [1.0, -1.0])], schema), spark.createDataFrame([(0, "x", 0.5), (1, "y", 0.0)], "position int, label string, intercept double"))
    models = tables.Analysis(linear, linear, spark.createDataFrame([("card", [0.9, 0.1])], "term string, weights array<double>"))
    found = tables.analyzed(letters.select("id", F.col("narrative").alias("clean_text")), "id", models, {}, {})
    assert "split(" not in plan(found) and found.count() == letters.count()


def test_rare_terms_stay_behind(spark, monkeypatch):
    """The vocabulary is that of counting every term, however buckets fall together and however high the first guess is."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{chr(97 + min(int(w), 25))}{'x' * (int(w) // 26 % 20)}" for w in rng.zipf(1.3, 40))) for i in range(80)]
    rows += [(100 + i, "once " * 300 + f"only{chr(97 + i)} " * 200) for i in range(3)] + [(200, None), (201, "")]
    texts = spark.createDataFrame(rows, "id long, clean_text string")
    made = vectors.with_terms(texts.na.drop(), ngram_max=3)
    shown, count = [], vectors.counted_terms
    monkeypatch.setattr(vectors, "counted_terms", lambda *a: shown.append(count(*a)) or shown[-1])
    for bits in (20, 9):
        monkeypatch.setattr(vectors, "BUCKETS", 1 << bits)
        monkeypatch.setattr(vectors, "SLICE", 1 << 8)
        for size, min_df in ((5, 3), (40, 2), (10, 50), (100_000, 1)):
            shown.clear()
            found = vectors.fit_vocabulary(texts, size, min_df, ngram_max=3).vocabulary
            assert found == vectors.fit_vocabulary(made, size, min_df, ngram_max=3).vocabulary
            if (bits, size) == (20, 5):
                assert shown[0].count() < count(texts, "clean_text", 3).count() / 4
            if (size, min_df) == (10, 50):
                assert len(shown) > 1


def test_fits_leave_only_the_split(spark, letters, monkeypatch):
    stored, stage = {}, classify.stage
    monkeypatch.setattr(classify, "stage", lambda df, name: stored.setdefault(name, []).append(out := stage(df, name)) or out)
    p, texts = Params(min_class_rows=10, max_iter=3, topics=2, topic_min_df=2), classify.text_rows(letters, "narrative")
    folders = lambda: {name: [os.path.dirname(d.inputFiles()[0].removeprefix("file:")).replace("///", "/") for d in found] for name, found in stored.items()}
    monkeypatch.setattr(classify, "unstage", lambda df, f=classify.unstage: at.update(folders()) or f(df))
    at: dict[str, list[str]] = {}
    model = classify.train_classifier(texts, "Product", "id", None, p)
    classify.tune_classifier(texts.where(F.length("clean_text") > 0), "Product", "id", p, (classify.Candidate(), classify.Candidate(vocabulary=9)))
    classify.train_topics(texts, p)
    left = {name: [os.path.exists(f) for f in found] for name, found in {**at, **folders()}.items()}
    assert left == {"labelled": [False] * 2, "training": [True] * 2, "features": [False] * 3, "topic-counts": [False]}
    assert model.test.count() == 32
