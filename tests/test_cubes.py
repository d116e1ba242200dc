"""Cubes added up step by step against one cube over all rows."""

import functools

import pytest
from pyspark.sql import DataFrame, functions as F

from casemill.operators.facts import cube
from casemill.operators.ingest import dedupe_first
from casemill.plans import registry
from casemill.plans.registry import SUMMARY_COLUMNS, cases
from casemill.plans.summaries import Analysis, analysis_tables, count_tables
from casemill.session import shuffles_removed
from casemill.sources import star
from casemill.streaming import cubes
from casemill.streaming.ingest import ingest_available, stored_cases
from test_ingest import record, write

ORDER = ["step", *SUMMARY_COLUMNS]


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def steps(spark, data):
    """Three deliveries; the last brings a part of the first again, and some rows have no id."""
    rows = cases(spark, data, ("Complaint ID", *SUMMARY_COLUMNS))
    rows = rows.withColumn("Complaint ID", F.when(F.col("Complaint ID") % 97 > 0, F.col("Complaint ID")))
    step = F.pmod(F.hash("Company", "Year"), F.lit(3))
    parts = rows.withColumn("step", step)
    return parts.union(parts.where((F.col("step") == 0) & (F.col("Month") < 4)).withColumn("step", F.lit(2))).cache()


def test_all_count_tables_equal_a_full_run(spark, steps, tmp_path):
    target = str(tmp_path / "cube")
    for k in (0, 1, 2, 2):  # the last step is tried twice
        cubes.add_step(steps.where(F.col("step") == k).drop("step"), target, k, [F.col(c) for c in ORDER[1:]])
        if k == 1:
            assert cubes.merge_steps(spark, target) == 1
    found = cubes.stored_cube(spark, target)
    whole = cube(dedupe_first(steps, ["Complaint ID"], [F.col(c) for c in ORDER]).drop("step", "Complaint ID"))
    assert rows_of(found.df) == rows_of(whole.df)
    a = {**count_tables(found), **analysis_tables(Analysis(found))}
    b = {**count_tables(whole), **analysis_tables(Analysis(whole))}
    assert len(a) == 36
    for name in ("kpis", "company_resolution", "narrative_length_trend", "driver_analysis", "recommendations"):
        assert rows_of(a[name]) == rows_of(b[name])


def test_unfinished_steps_are_not_read(spark, steps, tmp_path):
    target = tmp_path / "cube"
    with pytest.raises(ValueError, match="no steps"):
        cubes.stored_cube(spark, str(target))
    cubes.add_step(steps.where("step = 0").drop("step"), str(target), 0)
    before = rows_of(cubes.stored_cube(spark, str(target)).df)
    cubes.add_step(steps.where("step = 1").drop("step"), str(target), 1)
    (target / "cube" / "step=1" / "_SUCCESS").unlink()
    assert rows_of(cubes.stored_cube(spark, str(target)).df) == before


def test_ingest_keeps_a_cube(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    target, state, cube_at = (str(tmp_path / x) for x in ("out", "state", "cube"))
    write(source / "a.csv", [record(), record(**{"Complaint ID": "2", "Product": "Loan"})])
    ingest_available(spark, str(source), target, state, cube=cube_at).awaitTermination()
    write(source / "b.csv", [record(Product="later"), record(**{"Complaint ID": "3"}), record(**{"Complaint ID": None})])
    ingest_available(spark, str(source), target, state, cube=cube_at).awaitTermination()
    found = {r["Product"]: r["rows"] for r in cubes.stored_cube(spark, cube_at).by("Product").collect()}
    assert found == {"sample": 3, "Loan": 1}
    assert rows_of(cubes.stored_cube(spark, cube_at).df) == rows_of(cube(stored_cases(spark, target)).df)


def test_rows_are_moved_only_where_ids_come_again(spark, tmp_path):
    rows = [(1, "b"), (1, "a"), (2, "c"), (None, "z"), (None, "y"), (3, "d")]
    df = spark.createDataFrame(rows, "`Complaint ID` long, Product string")
    order = [F.col("Product")]
    df.where("Product = 'd'").select("Complaint ID").write.parquet(str(tmp_path / "ids"))
    df.where("`Complaint ID` is null").select("Complaint ID").write.parquet(str(tmp_path / "none"))
    found = lambda rows, *earlier: sorted(map(str, (tuple(r) for r in cubes._first_rows(rows, [str(tmp_path / e) for e in earlier], order).collect())))
    assert found(df) == ["(1, 'a')", "(2, 'c')", "(3, 'd')", "(None, 'y')"]
    assert found(df, "ids") == ["(1, 'a')", "(2, 'c')", "(None, 'y')"]
    assert found(df, "ids", "none") == ["(1, 'a')", "(2, 'c')"]
    once = cubes._first_rows(df.where("Product in ('a', 'c', 'y')"), [str(tmp_path / "ids")], order)
    assert once.count() == 3 and "Exchange" not in once._jdf.queryExecution().executedPlan().toString()


def test_parts_of_a_step_equal_whole_steps(spark, steps, tmp_path):
    """Parts that share no id, one of them empty; ids of an earlier step come again, and the last step is tried twice."""
    order, part = [F.col(c) for c in ORDER[1:]], F.pmod(F.hash("Complaint ID"), F.lit(3))
    for k in (0, 1, 2, 2):
        rows = steps.where(F.col("step") == k).drop("step")
        cubes.add_step(rows, str(tmp_path / "whole"), k, order)
        cubes.add_step([rows.where(part == i) for i in range(4)], str(tmp_path / "parts"), k, order)
    found, wanted = (cubes.stored_cube(spark, str(tmp_path / x)) for x in ("parts", "whole"))
    assert rows_of(found.df) == rows_of(wanted.df)
    assert found.by().first()["rows"] == dedupe_first(steps, ["Complaint ID"], order).count()


def test_stepwise_cube_is_joined_in_parts(spark, data, monkeypatch):
    whole = rows_of(registry.stepwise_cube(spark, data).df)
    seen, stage = [], registry.stage
    monkeypatch.setattr(registry, "stage", lambda df, name: seen.append(name) or stage(df, name))
    monkeypatch.setattr(registry, "_models", {})
    monkeypatch.setattr(star, "PART_BYTES", 40_000)
    n = star.part_count(spark, data)
    assert rows_of(registry.stepwise_cube(spark, data).df) == whole and n > 1 and seen == ["cases"] * n
    parts = [cases(spark, data, SUMMARY_COLUMNS, part=(i, n)) for i in range(n)]
    assert rows_of(functools.reduce(DataFrame.union, parts)) == rows_of(cases(spark, data, SUMMARY_COLUMNS))


def test_shuffles_go_with_their_query(spark, tmp_path):
    """Inside the block no shuffle file is left once a query has ended; the setting is as before afterwards."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    with shuffles_removed(spark):
        df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        df.write.parquet(str(tmp_path / "a"))
        assert spark.conf.get(key) == "true" and df.count() == 7 and df.collect() == df.collect()
    assert spark.conf.get(key) == before
