"""The registered queries against their SQL, and the pipeline against its stages' rules."""

import pytest

import corpus_pipeline
from casemill.llm.queries import ORACLE, QUERIES
from compare import connect, differences


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, data, con, name):
    assert differences(QUERIES[name](spark, data), con, ORACLE[name]) == []


def test_all_are_registered():
    from __spark_entry__ import queries

    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))
    assert "pipeline" in queries() and set(QUERIES) <= set(queries())


def test_pipeline(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs_out = stage(spark, docs, data)
        assert docs_out.columns == docs.columns, name
        docs = docs_out.cache()
        kept.append(docs.count())
    assert kept[0] > kept[1] > kept[2] >= kept[3] > 0
    shards = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    assert sum(r["n_slots"] * r["stride"] == len(r["payload"]) for r in shards.collect()) == shards.count() > 0
    assert corpus_pipeline.run(spark, data).columns == shards.columns
