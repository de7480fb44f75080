"""The data behind each report page, as named frames.

Every function takes frames and returns frames, so each figure is one small aggregation
over a column-pruned scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.functions.expr import aqi_category, aqi_color, floor_hour, hour_label, on_day
from airloom.operators.joins import category_join, nearest_reading
from airloom.operators.stats import (
    aqi_stats, box_summary, category_share, corr_matrix, corr_target, daily_summary, describe,
    headline_metrics, histogram, melt_metrics, missing_report, recent_trend, shape_report,
    table_counts, value_summary,
)
from airloom.operators.timeseries import first_rows, last_rows, latest
from airloom.schemas import OUTLIER_COLUMNS, category_dim
from airloom.sources.registry import model_report

Report = dict[str, DataFrame]


def overview(
    raw_aqi: DataFrame, features: DataFrame, models: DataFrame, *,
    keys: Sequence[str] = ("city",), order: str = "ts",
) -> Report:
    """Table sizes, the latest index with its category, and the last week."""
    return {
        "counts": table_counts(
            {"raw_aqi": raw_aqi, "feature_store": features, "model_registry": models}),
        "latest": latest_aqi(raw_aqi, keys=keys, order=order),
        "last_week": last_rows(raw_aqi.select(*keys, order, "us_aqi"), 168, keys=keys, order=order),
    }


def latest_aqi(
    raw_aqi: DataFrame, *, keys: Sequence[str] = ("city",), order: str = "ts"
) -> DataFrame:
    """Most recent index of each series with category and colour."""
    return latest(raw_aqi, ["us_aqi"], keys=keys, order=order).withColumns(
        {"category": aqi_category("us_aqi"), "color": aqi_color("us_aqi")}
    )


def data_analysis(
    df: DataFrame, *, columns: Sequence[str] | None = None, bins: int = 50, approx: bool = False,
    order: str = "ts",
) -> Report:
    """Shape, distribution, correlation and time series of the prepared data."""
    return {
        "shape": shape_report(df, order=order),
        "describe": describe(df, columns, approx=approx),
        "missing": missing_report(df),
        "aqi_stats": aqi_stats(df, order=order, approx=approx),
        "correlation": corr_matrix(df, columns),
        "correlation_with_aqi": corr_target(df, columns=columns),
        "boxes": box_summary(df, [c for c in OUTLIER_COLUMNS if c in df.columns], approx=approx),
        **{f"histogram_{c}": histogram(df, c, bins)
           for c in ("pm2_5", "pm10", "temp", "humidity") if c in df.columns},
        "series": df.select(
            order, *[c for c in ("us_aqi", "temp", "humidity", "pm2_5", "pm10") if c in df.columns]
        ).orderBy(order),
    }


def model_performance(comparison: DataFrame) -> Report:
    """Comparison table and its train/test pairs per metric."""
    return {
        "comparison": comparison.orderBy(F.col("R2 (Test)").desc()),
        **{metric: melt_metrics(comparison, metric) for metric in ("R2", "MAE", "RMSE")},
    }


def current_prediction(
    predictions: DataFrame, now: Column, *, keys: Sequence[str] = ("city",), order: str = "ts"
) -> Report:
    """The prediction closest to now, and the first 24 predictions."""
    return {
        "current": nearest_reading(predictions, now, keys=keys, order=order).withColumns(
            {"category": aqi_category("predicted_aqi"), "color": aqi_color("predicted_aqi")}
        ),
        "first_24": first_rows(predictions, 24, keys=keys, order=order),
    }


def forecast_report(
    predictions: DataFrame, *, bins: int = 30, keys: Sequence[str] = ("city",), order: str = "ts"
) -> Report:
    """Headline numbers, daily and hourly tables, distribution, temperature, categories."""
    return {
        "headline": headline_metrics(predictions, keys=keys),
        "daily": daily_summary(predictions, keys=keys, order=order),
        "hourly": hourly_table(predictions, keys=keys, order=order),
        "histogram": histogram(predictions, "predicted_aqi", bins),
        "category_share": category_share(predictions, keys=keys),
        "temperature": value_summary(predictions, "temp", keys=keys, order=order),
        "advice": category_join(predictions.select(*keys, order, "predicted_aqi"), "predicted_aqi"),
        "categories": category_dim(predictions.sparkSession),
    }


def hourly_table(
    predictions: DataFrame, *, keys: Sequence[str] = ("city",), order: str = "ts"
) -> DataFrame:
    """Hour label, predicted index and category of each forecast row."""
    return predictions.select(
        *keys, hour_label(order).alias("hour_label"), "predicted_aqi",
        F.col("aqi_category").alias("category"),
    )


def current_weather(
    raw_weather: DataFrame, now: Column, *, keys: Sequence[str] = ("city",), order: str = "ts"
) -> Report:
    """The reading closest to the current hour, and today's temperature and humidity."""
    return {
        "current": nearest_reading(raw_weather, floor_hour(now), keys=keys, order=order),
        "today": on_day(raw_weather, now, order).select(*keys, order, "temp", "humidity"),
    }


def accuracy_report(
    raw_aqi: DataFrame, models: DataFrame, errors: DataFrame | None = None, *,
    keys: Sequence[str] = ("city",), order: str = "ts",
) -> Report:
    """Recent readings, their trend, model verdicts and, if given, back-test errors."""
    report = {
        "recent": last_rows(raw_aqi.select(*keys, order, "us_aqi"), 20, keys=keys, order=order),
        "trend": recent_trend(raw_aqi, keys=keys, order=order),
        "models": model_report(models),
    }
    if errors is not None:
        report["errors"] = errors
        report["error_summary"] = errors.groupBy(*keys).agg(
            F.avg("abs_error").alias("mae"),
            F.sqrt(F.avg(F.col("abs_error") * F.col("abs_error"))).alias("rmse"),
        )
    return report
