"""Moving average, regression and their blend for one or many series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.rounding import half_even
from tallyworks.operators import regression, sums
from tallyworks.operators import series as monthly_series
from tallyworks.session import settle

# The regression's share of the blend, by hold-out R2.
STRONG_FIT = 0.8
STRONG_SHARE = 0.65
EVEN_SHARE = 0.50


def fit(series: DataFrame) -> DataFrame:
    return regression.fit(monthly_series.with_split(monthly_series.with_features(series)))


def fit_many(series: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Models and hold-out metrics of any number of series, fitted from sums that merge.

    Both are settled: one row a series, which the forecast needs several times.
    """
    split = monthly_series.with_split(monthly_series.with_features(series))
    models = settle(sums.fit(split), "models")
    predicted = sums.hold_out_predictions(split, models)
    return models, settle(regression.hold_out_metrics(predicted), "metrics")


def metrics(models: DataFrame) -> DataFrame:
    return regression.hold_out_metrics(regression.hold_out_predictions(models))


def blend(ma: Column, lr: Column, r2: Column) -> Column:
    """Weighted mean of the rounded forecasts; the moving average where no model exists."""
    share = F.when(r2 > STRONG_FIT, F.lit(STRONG_SHARE)).otherwise(F.lit(EVEN_SHARE))
    mixed = half_even(share * lr + (F.lit(1.0) - share) * ma)
    return F.when(lr.isNull(), ma).otherwise(mixed)


def forecast_detail(
    series: DataFrame,
    window: int = 3,
    horizon: int = 6,
    models: DataFrame | None = None,
    held_out: DataFrame | None = None,
) -> DataFrame:
    """(series, period, type, ma_3_forecast, lr_forecast, ensemble_forecast).

    ``held_out`` has the metrics of models that do not carry their hold-out rows.
    """
    models = fit(series) if models is None else models
    held_out = metrics(models) if held_out is None else held_out
    ma = monthly_series.moving_average_forecast(series, window, horizon)
    lr = regression.regression_forecast(models, horizon).drop("period")
    paired = ma.join(lr, ["series", "step"], "left").join(
        held_out.select("series", "r2"), "series", "left"
    )
    return paired.select(
        "series",
        "period",
        F.lit("Forecast").alias("type"),
        F.col("ma_forecast").alias("ma_3_forecast"),
        "lr_forecast",
        blend(F.col("ma_forecast"), F.col("lr_forecast"), F.col("r2")).alias("ensemble_forecast"),
    ).orderBy("series", "period")


def actuals_and_forecast(series: DataFrame, detail: DataFrame) -> DataFrame:
    """(series, period, type, revenue): history followed by the blended forecast."""
    actuals = series.select(
        "series",
        "period",
        F.lit("Actual").alias("type"),
        F.col("revenue").cast("double").alias("revenue"),
    )
    coming = detail.withColumnRenamed("ensemble_forecast", "revenue").select(actuals.columns)
    return actuals.unionByName(coming).orderBy("series", "period")


def run_summary(models: DataFrame) -> DataFrame:
    """(series, train_rows, test_rows, r2, mape, accuracy, mae, rmse)."""
    return (
        models.select("series", "train_rows")
        .join(metrics(models), "series", "left")
        .select("series", "train_rows", "test_rows", "r2", "mape", "accuracy", "mae", "rmse")
        .orderBy("series")
    )
