from datetime import datetime

import pytest
from pyspark.sql import functions as F

from casemill.functions import dates, labels, text


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_safe_growth(spark):
    df = spark.createDataFrame([(1, 150, 100), (2, 10, 0), (3, 0, 0), (4, 5, None)], "i int, c int, p int")
    got = [r[0] for r in df.orderBy("i").select(labels.safe_growth(F.col("c"), F.col("p"))).collect()]
    assert got == [50.0, 999.0, 0.0, 0.0]


def test_growth_label_bounds_are_inclusive(spark):
    got = values(spark, labels.growth_label(F.col("x")), [999.0, 25.0, 5.0, 0.0, -5.0, -25.0, 24.9, 4.9], "double")
    assert got == ["New / Emerging", "Rising Fast", "Rising", "Stable", "Declining", "Declining Fast", "Rising", "Stable"]


def test_levels_and_buckets(spark):
    assert values(spark, labels.risk_level(F.col("x")), [80.0, 70.0, 50.0, 40.0, 20.0], "double") == [
        "High", "High", "Medium", "Medium", "Low"]
    assert values(spark, labels.complexity(F.col("x")), [0, 50, 51, 150, 151], "int") == [
        "Low", "Low", "Medium", "Medium", "High"]
    assert values(spark, labels.trend_label(F.col("x")), [5.0, -5.0, 4.9], "double") == [
        "Increasing", "Decreasing", "Stable"]
    assert values(spark, labels.forecast_quality(F.col("x")), [9.0, 10.0, 20.0, 30.0], "double") == [
        "Excellent", "Good", "Acceptable", "Poor"]


def test_whole_count_clips_and_rounds_half_even(spark):
    assert values(spark, labels.whole_count(F.col("x")), [-3.2, 2.5, 3.5, 1.2], "double") == [0, 2, 4, 1]


def test_min_max_scale(spark):
    df = spark.createDataFrame([(10.0, 10.0, 30.0), (30.0, 10.0, 30.0), (5.0, 5.0, 5.0)], "v double, a double, b double")
    got = [r[0] for r in df.select(labels.min_max_scale(F.col("v"), F.col("a"), F.col("b"))).collect()]
    assert got == [0.0, 1.0, 0.0]


def test_clean_text(spark):
    rows = ["I paid XXXX $1,200 on XX/XX/2021!", "é accentué", "xxl boxx xx", "  \n ", None]
    assert values(spark, text.clean_text(F.col("x")), rows) == ["i paid on", "accentu", "xxl boxx", "", None]


def test_strip_and_counts(spark):
    rows = ["  a  b\t\n", "", "   ", None]
    assert values(spark, text.strip(F.col("x")), rows) == ["a  b", "", "", None]
    assert values(spark, text.word_count(F.col("x")), rows) == [2, 0, 0, 0]
    assert values(spark, text.char_count(F.col("x")), ["aé", None]) == [2, 0]


def test_ascii_words_do_not_split_accented_words(spark):
    assert values(spark, text.ascii_words(F.col("x")), ["The élan cafés abc123 a_b ok FINE"]) == [["the", "fine"]]


def test_ngrams(spark):
    words = F.split(F.col("x"), " ")
    assert values(spark, text.ngrams(words, 2), ["a b c", "a"]) == [["a b", "b c"], []]
    assert values(spark, text.ngrams_up_to(words, 3), ["a b c"]) == [["a", "b", "c", "a b", "b c", "a b c"]]


def test_two_decimals(spark):
    assert values(spark, text.two_decimals(F.col("x")), [2.675, 1234567.0, -0.5], "double") == [
        f"{v:.2f}" for v in (2.675, 1234567.0, -0.5)]


@pytest.mark.parametrize("raw, expected", [
    ("2021-03-04", datetime(2021, 3, 4)), ("2021-03-04T05:06:07Z", datetime(2021, 3, 4, 5, 6, 7)),
    ("2021-03-04T05:06:07+02:00", datetime(2021, 3, 4, 3, 6, 7)), ("03/04/2021", datetime(2021, 3, 4)),
    ("3/4/2021 15:30", datetime(2021, 3, 4, 15, 30)), ("3/4/2021 3:30 PM", datetime(2021, 3, 4, 15, 30)),
    ("20210304", datetime(2021, 3, 4)), ("March 4, 2021", datetime(2021, 3, 4)), ("4 Mar 2021", datetime(2021, 3, 4)),
    ("not a date", None), ("2021-13-45", None), ("13/45/2021", None), ("", None), (None, None),
])
def test_parse_timestamp(spark, raw, expected):
    stamp = F.date_format(dates.parse_timestamp(F.col("x")), "yyyy-MM-dd HH:mm:ss")
    got = values(spark, stamp, [raw])[0]
    assert got == (expected and expected.strftime("%Y-%m-%d %H:%M:%S"))


def test_whole_days_are_floored(spark):
    df = spark.createDataFrame([("2021-01-02 06:00:00", "2021-01-02 00:00:00"), ("2021-01-01 00:00:00", "2021-01-03 23:00:00")],
                               "a string, b string").select(F.to_timestamp("a").alias("a"), F.to_timestamp("b").alias("b"))
    assert [r[0] for r in df.select(dates.whole_days_between(F.col("a"), F.col("b"))).collect()] == [-1, 2]
