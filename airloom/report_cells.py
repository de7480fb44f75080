"""Which cells of the report pages the registered queries compare.

Per page and frame: the columns that identify a row, and the compared ones; a leading ``=`` marks a label.
"""

from __future__ import annotations

Cells = dict[str, tuple[tuple[str, ...], tuple[str, ...]]]

ANALYSED = ("temp", "pm2_5", "us_aqi")

PAGES: dict[str, Cells] = {
    "page_overview": {
        "counts": (("table_name",), ("n",)),
        "latest": (("city", "ts"), ("us_aqi", "=category", "=color")),
        "last_week": (("city", "ts"), ("us_aqi",)),
    },
    "page_data_analysis": {
        "shape": ((), ("row_count", "column_count", "=column_names", "=first_ts", "=last_ts")),
        "describe": (("column_name",), ("count", "mean", "std", "min", "q25", "q50", "q75", "max")),
        "missing": (("column_name",), ("missing", "pct")),
        "aqi_stats": ((), ("n", "mean", "median", "std", "min", "max", "=first_ts", "=last_ts")),
        "correlation": (("col_a", "col_b"), ("r",)),
        "correlation_with_aqi": (("column_name",), ("r",)),
        "boxes": (("column_name",), ("q25", "q50", "q75", "whisker_low", "whisker_high", "outliers")),
        "histogram_pm2_5": (("bin",), ("bin_low", "bin_high", "n")),
        "histogram_temp": (("bin",), ("bin_low", "bin_high", "n")),
        "series": (("ts",), ("us_aqi", "temp", "humidity", "pm2_5", "pm10")),
    },
    "page_model_performance": {
        "comparison": (("Model",), ("R2 (Train)", "R2 (Test)", "MAE (Train)", "MAE (Test)", "RMSE (Train)", "RMSE (Test)")),
        "R2": (("Model", "Dataset"), ("value",)),
        "MAE": (("Model", "Dataset"), ("value",)),
        "RMSE": (("Model", "Dataset"), ("value",)),
    },
    "page_current_prediction": {
        "current": (("city", "ts"), ("predicted_aqi", "=category", "=color")),
        "first_24": (("city", "ts"), ("predicted_aqi",)),
    },
    "page_forecast": {
        "headline": (("city",), ("avg_aqi", "max_aqi", "min_aqi", "=most_common")),
        "daily": (("city", "day"), ("avg_aqi", "min_aqi", "max_aqi", "=category")),
        "hourly": (("city", "hour_label"), ("predicted_aqi", "=category")),
        "histogram": (("bin",), ("bin_low", "bin_high", "n")),
        "category_share": (("city", "aqi_category"), ("n", "share")),
        "temperature": (("city",), ("n", "mean", "min", "max", "=first_ts", "=last_ts")),
        "advice": (("city", "ts"), ("predicted_aqi", "=category", "=zone", "=advice")),
        "categories": (("category",), ("=zone", "=color")),
    },
    "page_accuracy": {
        "recent": (("city", "ts"), ("us_aqi",)),
        "trend": (("city",), ("mean", "std", "min", "max", "latest", "mean_recent", "=trend")),
        "models": (("model_name",), ("r2_test", "mae_test", "rmse_test", "=status")),
        "errors": (("city", "ts"), ("predicted", "actual", "abs_error", "error_pct")),
        "error_summary": (("city",), ("mae", "rmse")),
    },
}
