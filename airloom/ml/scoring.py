"""Score forecasts and back-test stored features with a registered model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.functions.expr import abs_error, aqi_category, error_pct
from airloom.ml.features import align_features
from airloom.operators.joins import pair_by_key
from airloom.operators.timeseries import last_rows


def predict(
    df: DataFrame, model: PipelineModel, names: Sequence[str], *, name: str = "predicted_aqi",
    keys: Sequence[str] = ("city", "ts"),
) -> DataFrame:
    """Predictions (keys and value) for rows whose features are aligned to ``names``."""
    scored = model.transform(align_features(df, names, keep=keys))
    return scored.select(*keys, F.col("prediction").alias(name))


def score_forecast(
    features: DataFrame, model: PipelineModel, names: Sequence[str], model_name: str, *,
    predicted_at: Column | None = None, keys: Sequence[str] = ("city", "ts"),
) -> DataFrame:
    """Forecast rows with predicted index, its category, the model's name and the time.

    The aligned inputs travel beside the forecast columns, so no join is needed.
    """
    given = [F.struct(*features.columns).alias("_row")]
    renamed = features.select(*given, *features.columns)
    aligned = align_features(renamed, names, keep=("_row",))
    scored = model.transform(aligned)
    return scored.select(
        "_row.*", F.col("prediction").alias("predicted_aqi"),
    ).withColumns({
        "model_name": F.lit(model_name),
        "predicted_at": F.current_timestamp() if predicted_at is None else predicted_at,
        "aqi_category": aqi_category("predicted_aqi"),
    })


def backtest(
    features: DataFrame, actuals: DataFrame, model: PipelineModel, names: Sequence[str], *,
    rows: int = 24, value: str = "us_aqi", keys: Sequence[str] = ("city",), order: str = "ts",
) -> DataFrame:
    """Per-row errors of the model on the last stored rows of each series."""
    recent = last_rows(features, rows, keys=keys, order=order)
    on = [*keys, order]
    predicted = predict(recent, model, names, name="predicted", keys=on)
    paired = pair_by_key(predicted, actuals.select(*on, F.col(value).alias("actual")), on)
    return error_rows(paired)


def error_rows(paired: DataFrame) -> DataFrame:
    """Absolute and percentage error beside each (predicted, actual) pair."""
    return paired.withColumns({
        "abs_error": abs_error("predicted", "actual"),
        "error_pct": error_pct("predicted", "actual"),
    })
