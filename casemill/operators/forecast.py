"""Seasonal-trend forecast of monthly counts, for one series or for many at once.

A series is a straight line plus one additive effect per calendar month: the line is a least-squares fit,
the effect is the mean residual of the month. All series are fitted in one pass of window aggregates over
the monthly table, partitioned by series; a partition holds the months of the training years only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from casemill.functions import labels
from casemill.params import DEFAULTS, Params
from casemill.sources.complaints import require_columns

# Width of the 80 % band in standard deviations, and the name of the model.
BAND = 1.2816
MODEL = "Seasonal trend"
MIN_MONTHS = 12
MIN_VALIDATION_MONTHS = 18
ALL = "_series"


def _keys(series: Sequence[str]) -> list[str]:
    return list(series) or [ALL]


def training_months(monthly: DataFrame, series: Sequence[str] = (), p: Params = DEFAULTS) -> DataFrame:
    """The last complete years of every series; its last year counts as partial and is left out."""
    require_columns(monthly, ["Year", "Month", "Complaints", *series])
    rows = monthly.na.drop(subset=["Year", "Month", "Complaints"]).select(*series, "Year", "Month", "Complaints")
    if not series:
        rows = rows.withColumn(ALL, F.lit("all"))
    by = W.partitionBy(*_keys(series))
    rows = rows.withColumn("_partial", F.max("Year").over(by)).filter(F.col("Year") < F.col("_partial"))
    rows = rows.withColumn("_latest", F.max("Year").over(by))
    rows = rows.filter(F.col("Year") > F.col("_latest") - p.training_years)
    return rows.withColumn("_months", F.count(F.lit(1)).over(by))


def _enough(rows: DataFrame, strict: bool) -> DataFrame:
    enough = F.col("_months") >= MIN_MONTHS
    if not strict:
        return rows.filter(enough)
    message = F.lit("Not enough monthly data available for forecasting.")
    # as a scalar, so that it is reached when no row is left
    known = rows.agg(F.when(F.count(F.lit(1)) > 0, True).otherwise(F.raise_error(message).cast("boolean"))).scalar()
    return rows.filter(known & F.when(enough, True).otherwise(F.raise_error(message).cast("boolean")))


def _line(fit: Column, by, t: Column) -> tuple[Column, Column]:
    """Slope and intercept over the rows where ``fit`` is not null. A flat or single-point series has a
    slope of 0 and its mean as intercept."""
    slope = F.coalesce(F.regr_slope(fit, t).over(by), F.lit(0.0))
    mean_t = F.avg(F.when(fit.isNotNull(), t)).over(by)
    return slope, F.avg(fit).over(by) - slope * mean_t


def fitted(train: DataFrame, series: Sequence[str] = (), p: Params = DEFAULTS) -> DataFrame:
    """Training rows with the full fit, and with the hold-out fit that leaves out the last months."""
    keys = _keys(series)
    by, by_month = W.partitionBy(*keys), W.partitionBy(*keys, "Month")
    rows = train.withColumn("_abs", F.col("Year") * 12 + F.col("Month") - 1)
    rows = rows.withColumn("t", (F.col("_abs") - F.min("_abs").over(by)).cast("double"))
    newest = W.partitionBy(*keys).orderBy(F.desc("_abs"))
    rows = rows.withColumn("_back", F.row_number().over(newest))
    y, t = F.col("Complaints").cast("double"), F.col("t")
    for name, fit in (("full", y), ("holdout", F.when(F.col("_back") > p.holdout_months, y))):
        slope, intercept = _line(fit, by, t)
        rows = rows.withColumn(f"{name}_slope", slope).withColumn(f"{name}_intercept", intercept)
        trend = F.col(f"{name}_intercept") + F.col(f"{name}_slope") * t
        rows = rows.withColumn(
            f"{name}_season", F.coalesce(F.avg(fit - trend).over(by_month), F.lit(0.0))
        ).withColumn(f"{name}_yhat", trend + F.col(f"{name}_season"))
    spread = F.coalesce(F.stddev_samp(y - F.col("full_yhat")).over(by), F.lit(0.0))
    return rows.withColumn("_sigma", spread)


def _output(rows: DataFrame, keys: Sequence[str], date: Column, value: Column, yhat: Column, kind: str) -> DataFrame:
    band = F.col("_sigma") * BAND
    return rows.select(
        *keys, date.alias("Date"), value.alias("Complaints"),
        labels.whole_count(yhat - band).alias("Lower_Bound"), labels.whole_count(yhat + band).alias("Upper_Bound"),
        F.lit(kind).alias("Type"), F.date_format(date, "yyyy-MM").alias("Period"),
    )


def _models(rows: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """The fitted model of every series in one row; the seasons are a map of at most twelve months."""
    return rows.groupBy(*keys).agg(
        F.max(F.make_date("Year", "Month", F.lit(1))).alias("last"), F.max("t").alias("t"),
        F.max("full_slope").alias("slope"), F.max("full_intercept").alias("intercept"),
        F.max("_sigma").alias("_sigma"),
        F.map_from_entries(F.collect_set(F.struct("Month", "full_season"))).alias("seasons"), *more,
    )


def _ahead(step: Column) -> tuple[Column, Column]:
    """Date and prediction ``step`` months after the last one."""
    date = F.add_months("last", step)
    season = F.coalesce(F.try_element_at("seasons", F.month(date)), F.lit(0.0))
    return date, F.col("intercept") + F.col("slope") * (F.col("t") + step) + season


def forecast(
    monthly: DataFrame, series: Sequence[str] = (), p: Params = DEFAULTS, strict: bool = True,
) -> DataFrame:
    """Training months with their actual counts, then the forecast months. ``strict`` makes a series that is
    too short an error; otherwise it has no forecast."""
    keys = _keys(series)
    rows = fitted(_enough(training_months(monthly, series, p), strict), series, p)
    month_start = F.make_date("Year", "Month", F.lit(1))
    past = _output(rows, keys, month_start, F.col("Complaints").cast("long"), F.col("full_yhat"), "Actual")

    steps = F.sequence(F.lit(1), F.lit(p.forecast_periods))
    ahead = _models(rows, keys).select("*", F.explode(steps).alias("step"))
    date, yhat = _ahead(F.col("step"))
    future = _output(ahead, keys, date, labels.whole_count(yhat), yhat, "Forecast")
    result = past.unionByName(future)
    return (result if series else result.drop(ALL)).orderBy(*series, "Date")


def forecast_errors(actual: Column, predicted: Column, where: Column) -> tuple[Column, Column]:
    """Mean absolute error, and mean absolute percentage error over the non-zero actual values."""
    mae = F.avg(F.when(where, F.abs(actual - predicted)))
    ratio = F.when(where & (actual != 0), F.abs((actual - predicted) / actual))
    return F.coalesce(mae, F.lit(0.0)), F.coalesce(F.avg(ratio) * 100, F.lit(0.0))


def validation(
    monthly: DataFrame, series: Sequence[str] = (), p: Params = DEFAULTS, strict: bool = True,
) -> DataFrame:
    """Errors over the last months when they are held out; 0 for a series that is too short for it."""
    rows = fitted(_enough(training_months(monthly, series, p), strict), series, p)
    return _errors(rows, _keys(series), p).drop(*([] if series else [ALL]))


def _error_columns(p: Params) -> tuple[Column, Column]:
    held_out = (F.col("_back") <= p.holdout_months) & (F.col("_months") >= MIN_VALIDATION_MONTHS)
    predicted = F.greatest(F.col("holdout_yhat"), F.lit(0.0))
    return forecast_errors(F.col("Complaints").cast("double"), predicted, held_out)


def _errors(rows: DataFrame, keys: Sequence[str], p: Params) -> DataFrame:
    mae, mape = _error_columns(p)
    out = rows.groupBy(*keys).agg(mae.alias("Validation_MAE"), mape.alias("Validation_MAPE"))
    return out.withColumn("Forecast_Quality", labels.forecast_quality(F.col("Validation_MAPE")))


def forecast_summary(
    monthly: DataFrame, series: Sequence[str] = (), p: Params = DEFAULTS, strict: bool = True,
) -> DataFrame:
    """One row per series: the training span, the next months, the expected change and the errors. The next
    months are computed inside the row of the model, so the fitted months are grouped just once."""
    keys = _keys(series)
    rows = fitted(_enough(training_months(monthly, series, p), strict), series, p)
    mae, mape = _error_columns(p)
    models = _models(
        rows, keys,
        F.max("_latest").alias("Training_End_Year"), F.max("_partial").alias("Excluded_Partial_Year"),
        F.max(F.when(F.col("_back") == 1, F.col("Complaints"))).cast("long").alias("Latest_Actual_Complaints"),
        mae.alias("Validation_MAE"), mape.alias("Validation_MAPE"),
    )
    steps = F.sequence(F.lit(1), F.lit(p.forecast_periods))
    models = models.withColumn("ahead", F.transform(steps, lambda s: labels.whole_count(_ahead(s)[1])))

    def next_months(n: int) -> Column:
        return F.aggregate(F.slice("ahead", 1, n), F.lit(0).cast("long"), lambda a, x: a + x)

    models = models.withColumn("Next_Month_Forecast", next_months(1))
    latest, following = F.col("Latest_Actual_Complaints"), F.col("Next_Month_Forecast")
    change = F.when(latest != 0, (following - latest) / latest * 100).otherwise(0.0)
    return models.withColumn("Expected_Change_Pct", change).select(
        *series,
        F.lit(MODEL).alias("Model"),
        (F.col("Training_End_Year") - p.training_years + 1).alias("Training_Start_Year"),
        "Training_End_Year", "Excluded_Partial_Year", "Latest_Actual_Complaints", "Next_Month_Forecast",
        next_months(3).alias("Next_3_Month_Forecast"), next_months(6).alias("Next_6_Month_Forecast"),
        "Expected_Change_Pct", labels.trend_label(F.col("Expected_Change_Pct"), p).alias("Forecast_Trend"),
        "Validation_MAE", "Validation_MAPE",
    )
