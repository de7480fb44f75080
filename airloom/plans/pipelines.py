"""Stage pipelines over a warehouse, and the end-to-end run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.functions.expr import drop_sparse, fill_us_aqi, numeric_columns
from airloom.ml.features import augment, forecast_features, forecast_weather
from airloom.ml.scoring import score_forecast
from airloom.ml.training import TrainingPlan, train_models
from airloom.operators.joins import merge_readings
from airloom.operators.outliers import zscore_filter
from airloom.operators.series import must_split
from airloom.operators.stats import daily_summary, value_summary
from airloom.operators.timeseries import fill_then_median
from airloom.schemas import OUTLIER_COLUMNS
from airloom.session import materialize
from airloom.sources.feeds import combine_feeds
from airloom.sources.metadata import FeatureStore
from airloom.sources.registry import ModelRegistry
from airloom.sources.tables import Warehouse


def ingest(
    warehouse: Warehouse, archive: DataFrame, forecast: DataFrame, aqi: DataFrame
) -> None:
    """Upsert decoded feeds; the forecast rewrites the hours it shares with the archive."""
    log = materialize(combine_feeds(archive, forecast))
    warehouse.raw_weather.upsert(log, seq="seq")
    warehouse.raw_aqi.upsert(materialize(aqi))


def clean(
    weather: DataFrame, aqi: DataFrame, *, outlier_columns: Sequence[str] = OUTLIER_COLUMNS,
    keys: Sequence[str] = ("city",), order: str = "ts", **series,
) -> DataFrame:
    """Join, repair, screen and augment readings."""
    # A joined series is no longer than its weather series, which is cheap to count.
    series["split"] = must_split(weather, keys, series.get("split"))
    joined = merge_readings(weather, aqi, keys=(*keys, order))
    indexed = joined.withColumn("us_aqi", fill_us_aqi())
    filled = fill_then_median(
        indexed, numeric_columns(indexed, exclude=tuple(keys)), keys=keys, order=order, **series
    )
    # fill_then_median reads a stored table; only cheap row-wise steps follow it.
    screened = zscore_filter(drop_sparse(filled), outlier_columns, keys=keys, stored=True)
    return augment(screened, keys=keys, order=order, **series)


def preprocess_data(warehouse: Warehouse, **options) -> DataFrame:
    """Raw tables to the preprocessed table. How long series are is kept beside the weather table."""
    if warehouse.raw_weather.exists():
        options = {"split": warehouse.raw_weather.lengths(options.get("keys", ("city",))), **options}
    return warehouse.preprocessed.overwrite(
        clean(warehouse.raw_weather.read(), warehouse.raw_aqi.read(), **options)
    )


def engineer_and_store_features(warehouse: Warehouse, *, approx: bool = False) -> DataFrame | None:
    """Preprocessed table to feature store and metadata; None if nothing is preprocessed."""
    if warehouse.preprocessed.is_empty():
        return None
    store = FeatureStore(warehouse)
    store.register_defaults()
    return store.store(warehouse.preprocessed.read(), approx=approx)


def train(warehouse: Warehouse, plan: TrainingPlan | None = None) -> DataFrame | None:
    """Feature store to three registered models; returns the comparison table."""
    if warehouse.features.is_empty():
        return None
    return train_models(warehouse.features.read(), ModelRegistry(warehouse), plan)


@dataclass
class Forecast:
    """Scored forecast rows and their summaries."""

    rows: DataFrame
    summary: DataFrame
    daily: DataFrame


def predict_aqi_forecast(
    warehouse: Warehouse, now: Column, *, hours: int = 144, keys: Sequence[str] = ("city",),
    order: str = "ts", **series,
) -> Forecast | None:
    """Score the forecast rows with the best registered model and store the result; None
    without forecast rows, a registered model or its files."""
    weather = forecast_weather(
        warehouse.raw_weather.read(since=now), now, hours=hours, keys=keys, order=order
    )
    registry = ModelRegistry(warehouse)
    row = registry.best(active_only=False)
    if row is None or weather.isEmpty():
        return None
    found = registry.load(row)
    if found is None:
        return None
    features = forecast_features(
        weather, warehouse.raw_aqi.read(), keys=keys, order=order,
        **{"split": False, **series},  # at most `hours` rows per series
    )
    model, row = found
    rows = warehouse.predictions.overwrite(
        score_forecast(features, model, row["feature_names"], row["model_name"])
    )
    return Forecast(
        rows, value_summary(rows, keys=keys, order=order), daily_summary(rows, keys=keys, order=order)
    )


def run(
    warehouse: Warehouse, archive: DataFrame, forecast: DataFrame, aqi: DataFrame, now: Column,
    plan: TrainingPlan | None = None,
) -> Forecast | None:
    """Ingest, preprocess, store features, train, and score the forecast."""
    ingest(warehouse, archive, forecast, aqi)
    preprocess_data(warehouse)
    engineer_and_store_features(warehouse)
    train(warehouse, plan)
    return predict_aqi_forecast(warehouse, now)


def instant(now: str) -> Column:
    """A literal instant, in UTC."""
    return F.lit(now).cast("timestamp_ntz")
