"""Every query against its SQL counterpart, and every query without one for its invariants."""

import pytest

from casemill.plans.oracle import ORACLE
from casemill.plans import registry
from casemill.plans.registry import QUERIES
from compare import connect, differences


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, data, con, name):
    assert differences(QUERIES[name](spark, data), con, ORACLE[name]) == []


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_classifier_averages_are_shares(spark, data):
    row = QUERIES["tfidf_classifier"](spark, data).first()
    assert all(0 <= v <= 1 for v in row)


def test_topics_have_words(spark, data):
    rows = QUERIES["lda_topics"](spark, data).collect()
    assert sorted(r["topic_id"] for r in rows) == list(range(10))
    assert all(0 < len(r["topic_words"]) <= 15 for r in rows)


def test_entry_runs(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0


def test_models_read_texts_that_are_cleaned_once(spark, data):
    """Sampling and splitting go over the rows many times; the texts are not cleaned again each time."""
    judged = registry._judged_texts(spark, data)
    for texts in (registry._stored_texts(spark, data), judged):
        assert "regexp_replace" not in texts._jdf.queryExecution().optimizedPlan().toString()
    assert registry._stored_texts(spark, data).inputFiles() == registry._stored_texts(spark, data).inputFiles()
    assert sorted(registry._stored_texts(spark, data).collect()) == sorted(registry._texts(spark, data).collect())
