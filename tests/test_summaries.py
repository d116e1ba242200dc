import decimal
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from casemill.operators import counts, drivers, forecast, growth, profile, recommend, risk
from casemill.operators.facts import cube
from casemill.params import Params
from casemill.plans.registry import SUMMARY_COLUMNS, cases
from casemill.plans.summaries import Analysis, count_tables, run_all
from casemill.session import checkpoint_folder

ROWS = [
    ("A", "x", "Yes", 2020, 1), ("A", "y", "No", 2020, 2), ("B", "x", None, 2021, 1), ("B", None, "Yes", 2021, 3),
    (None, "x", "Yes", 2022, None), ("C", "x", "Yes", None, 5),
]


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(ROWS, "Company string, Product string, `Timely response?` string, Year int, Resolution_Delay int")


def test_nulls_leave_counts_and_ties_go_to_the_lowest(small):
    assert [tuple(r) for r in counts.value_counts(small, "Company").collect()] == [("A", 2), ("B", 2), ("C", 1)]
    assert counts.mode_value(small, "Company").first()[0] == "A"
    assert counts.mode_value(small.filter("false"), "Company").first()[0] == "Not Available"
    assert counts.value_counts(small, "Company", nulls=True).count() == 4


def test_share_divides_by_all_rows_with_a_value(small):
    assert counts.shares(small, "Company", k=1).first()["Share_Pct"] == pytest.approx(40.0)


def test_kpis_skip_null_timeliness(spark, small):
    df = small.withColumns({"State": F.lit("S"), "Issue": F.lit(None).cast("string"), "Submitted via": F.lit("Web"),
                            "Has_Narrative": F.lit(1)})
    row = counts.kpis(df).first()
    assert row["timely_response_pct"] == pytest.approx(80.0)
    assert (row["total_complaints"], row["total_companies"], row["top_issue"]) == (6, 3, "Not Available")
    assert (row["peak_year"], row["peak_year_complaints"]) == (2020, 2)


def test_risk_scales_over_companies_above_the_floor(small):
    rows = {r["Company"]: r for r in risk.company_risk(small, Params(risk_floor=2)).collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"]["Complaint_Score"] == 0.0 and rows["A"]["Untimely_Score"] == 1.0 and rows["B"]["Delay_Score"] == 1.0
    assert rows["A"]["Risk_Score"] == pytest.approx(30.0) and rows["B"]["Risk_Score"] == pytest.approx(20.0)
    assert risk.company_risk(small, Params(risk_floor=100)).count() == 0


def test_drivers_fill_and_share(spark):
    df = spark.createDataFrame([("p", "i", None)] * 3 + [("p", "i", "Unknown"), ("p", "j", "s"), (None, "i", "s")],
                               "Product string, Issue string, `Sub-issue` string")
    top = drivers.top_drivers(drivers.all_drivers(df)).first()
    assert (top["Sub-issue"], top["Complaint_Count"], top["Driver_Contribution_Pct"]) == ("Unknown", 4, 80.0)


def test_growth_needs_two_complete_years(spark):
    df = spark.createDataFrame([("p", 2020), ("p", 2021)], "Product string, Year int")
    with pytest.raises(Exception, match="Not enough complete years"):
        growth.yoy_growth(df, "Product", Params(growth_floor=0)).collect()
    more = spark.createDataFrame([("p", 2019), ("q", 2021), ("p", 2021), ("p", 2021), ("p", 2023)], "Product string, Year int")
    rows = {r["Product"]: r for r in growth.yoy_growth(more, "Product", Params(growth_floor=1)).collect()}
    assert (rows["p"]["Previous_Year"], rows["p"]["Current_Year"], rows["p"]["YoY_Growth_Pct"]) == (2019, 2021, 100.0)
    assert rows["q"]["Growth_Label"] == "New / Emerging"
    assert growth.emerging(growth.yoy_growth(more, "Product", Params(growth_floor=1))).count() == 1


def monthly(spark, years, value):
    rows = [(y, m, value(y, m)) for y in years for m in range(1, 13)]
    return spark.createDataFrame(rows, "Year int, Month int, Complaints long")


def test_forecast_of_an_exact_seasonal_line(spark):
    season = [5, -5, 3, -3, 1, -1, 4, -4, 2, -2, 6, -6]
    table = monthly(spark, range(2015, 2022), lambda y, m: 1000 + 12 * (y - 2015) + m + 100 * season[m - 1])
    rows = forecast.forecast(table).collect()
    assert len(rows) == 54 and [r["Type"] for r in rows].count("Forecast") == 6
    assert rows[0]["Period"] == "2017-01" and rows[-1]["Period"] == "2021-06"
    assert rows[0]["Complaints"] == 1000 + 24 + 1 + 500
    summary = forecast.forecast_summary(table).first()
    assert (summary["Training_Start_Year"], summary["Training_End_Year"], summary["Excluded_Partial_Year"]) == (2017, 2020, 2021)
    assert summary["Next_6_Month_Forecast"] == sum(r["Complaints"] for r in rows[-6:])
    assert abs(rows[-6]["Complaints"] - (1000 + 72 + 1 + 500)) < 60


def test_short_series(spark):
    table = monthly(spark, [2020, 2021], lambda y, m: 10)
    row = forecast.forecast_summary(table).first()
    assert (row["Validation_MAE"], row["Validation_MAPE"], row["Next_Month_Forecast"], row["Forecast_Trend"]) == (0.0, 0.0, 10, "Stable")
    with pytest.raises(Exception, match="Not enough monthly data"):
        forecast.forecast(table.filter("Year = 2021 or Month < 12")).collect()
    with pytest.raises(ValueError, match="Complaints"):
        forecast.forecast(table.drop("Complaints"))
    several = table.filter("Year = 2021 or Month < 12").withColumn("k", F.lit("a")).unionByName(table.withColumn("k", F.lit("b")))
    assert {r["k"] for r in forecast.forecast(several, ["k"], strict=False).collect()} == {"b"}


def test_mape_ignores_zero_actuals(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 5.0)], "a double, p double")
    mae, mape = forecast.forecast_errors(F.col("a"), F.col("p"), F.lit(True))
    assert tuple(df.agg(mae, mape).first()) == (5.0, 50.0)
    assert df.filter("a = 0").agg(mape).first()[0] == 0.0


def test_advice(spark):
    df = spark.createDataFrame([("Fraud or SCAM",), ("Report a debt",), ("zzz",), (None,)], "x string")
    got = [r[0] for r in df.select(recommend.issue_advice(F.col("x"))).collect()]
    assert "fraud" in got[0] and "credit reporting" in got[1] and got[2] == got[3] == recommend.ISSUE_DEFAULT
    product = df.select(recommend.product_advice(F.lit("Credit reporting"))).first()[0]
    assert "credit reporting" in product


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (4, "b")], "n int, s string")
    assert profile.duplicate_rows(df).first()["Duplicate_Rows"] == 1
    assert tuple(profile.null_profile(df).first()) == ("s", 1, 25.0)
    row = profile.describe(df, "n").first()
    assert (row["count"], row["mean"], row["p50"], row["max"]) == (4, 2.0, 1.5, 4)
    assert {r["Column"]: r["Distinct_Values"] for r in profile.distinct_and_nulls(df, ["n", "s"]).collect()} == {"n": 3, "s": 2}


def test_cube_gives_the_same_tables_as_rows(spark, data):
    df = cases(spark, data, SUMMARY_COLUMNS).persist()
    p = Params(growth_floor=10)
    shared = cube(df)
    from_cube, from_rows = count_tables(shared, p), count_tables(counts.as_facts(df), p)
    key = lambda r: tuple(str(v) for v in r)
    for name in from_cube:
        left, right = (sorted(map(tuple, t[name].collect()), key=key) for t in (from_cube, from_rows))
        assert left == right, name
    rows = Analysis(df, p).risk.collect()
    assert rows == Analysis(shared, p).risk.collect()
    df.unpersist()


def test_run_all_writes_every_table(spark, data, tmp_path):
    staged = f"{checkpoint_folder(spark)}/casemill".removeprefix("file:")
    before = set(os.listdir(staged)) if os.path.isdir(staged) else set()
    tables = run_all(cases(spark, data, SUMMARY_COLUMNS), Params(growth_floor=10), str(tmp_path))
    assert set(os.listdir(staged)) - before == set()
    assert len(tables) == 39  # the 40th, word counts, needs the narrative column
    assert {p.name.removesuffix(".parquet") for p in tmp_path.iterdir()} == set(tables)


def test_quantiles_are_exact(spark, monkeypatch):
    monkeypatch.setattr(profile, "BUCKETS", 32)
    rng = np.random.default_rng(3)
    lists = {
        "double": [rng.normal(size=501).tolist(), (10.0 ** rng.uniform(-300, 300, 200) * rng.choice([-1, 1], 200)).tolist(), [1.5], [2.0] * 90 + [3.0],
                   [0.0, 5e-324, 5e-324, 1e-323], [-1.7e308, 1.7e308, 0.0, 3.0], [float("nan"), None, 1.0, 4.0]],
        "bigint": [rng.integers(-50, 50, 301).tolist(), [-(1 << 63), (1 << 63) - 1, 0, 1, (1 << 53) + 1]],
        "decimal(20,3)": [[decimal.Decimal(int(x)) / 1000 for x in rng.integers(-10**9, 10**9, 99)]],
    }
    for kind, cases in lists.items():
        for values in cases:
            df = spark.createDataFrame([(v,) for v in values], f"x {kind}").repartition(3)
            row = profile.describe(df, "x").first()
            real = sorted(v for v in values if v is not None and v == v)
            want = np.percentile(np.array(real, float), [25, 50, 75])
            assert row["count"] == len(real) and (row["min"], row["max"]) == (real[0], real[-1])
            assert [row["p25"], row["p50"], row["p75"]] == pytest.approx(want.tolist(), rel=1e-12)
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (1.0,), (2.0,), (float("inf"),)], "x double")
    row = profile.describe(df, "x").first()
    assert (row["p25"], row["p50"], row["p75"]) == (1.0, 2.0, float("inf"))
    row = profile.describe(df.filter("false"), "x").first()
    assert row["count"] == 0 and row["p50"] is None and row["std"] is None
