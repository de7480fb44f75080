from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from helpers import rows, to_spark
from pyspark.sql import functions as F

from airloom import schemas
from airloom.functions import expr
from airloom.ml import features as mlf
from airloom.ml import boosting, scoring, training
from airloom.plans import pipelines, reports
from airloom.sources import registry
from airloom.sources.metadata import FeatureStore
from airloom.sources.tables import Warehouse

START = pd.Timestamp("2024-01-01")
HOURS = 24 * 30
NOW = "2024-01-28 00:00:00"
PLAN = training.TrainingPlan(forest_trees=8, xgb_rounds=6, gbt_rounds=6)


def feeds_of(spark, seed=1):
    """Archive, forecast and pollutant rows of two cities with a daily cycle."""
    rng = np.random.default_rng(seed)
    frames = []
    for i, city in enumerate(("north", "south")):
        hours = np.arange(HOURS)
        cycle = np.sin(hours / 24 * 2 * np.pi)
        frames.append(pd.DataFrame({
            "city": city, "lat": 27.0 + i, "lon": 68.0, "ts": START + pd.to_timedelta(hours, "h"),
            "temp": 20 + 8 * cycle + rng.normal(0, 1, HOURS), "humidity": 50 - 10 * cycle + rng.normal(0, 2, HOURS),
            "pressure": 1010 + rng.normal(0, 2, HOURS), "wind_speed": np.abs(rng.normal(8, 3, HOURS)),
            "clouds": rng.integers(0, 100, HOURS).astype(float), "pm2_5": 30 + 15 * cycle + rng.normal(0, 2, HOURS)}))
    full = pd.concat(frames, ignore_index=True)
    full.loc[rng.random(len(full)) < 0.05, "temp"] = np.nan
    cut = pd.Timestamp(NOW)
    weather = ["city", "lat", "lon", "ts", *schemas.WEATHER_MEASURES]

    def origin(df, source):
        stamped = df.withColumns({"source": F.lit(source), "fetched_at": F.lit("2024-02-01").cast("timestamp")})
        return stamped.select(*[c for c in schemas.RAW_AQI.fieldNames() + list(schemas.WEATHER_MEASURES) if c in stamped.columns])

    archive = origin(to_spark(spark, full[full.ts < cut][weather]), schemas.SOURCE_ARCHIVE)
    ahead = full[full.ts >= cut - pd.Timedelta(hours=24)][weather]
    forecast = origin(to_spark(spark, ahead), schemas.SOURCE_FORECAST)
    past = full[full.ts < cut].copy()
    past["pm10"] = past.pm2_5 * 1.5
    for k, gas in enumerate(("carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone")):
        past[gas] = past.pm2_5 * (k + 1) + rng.normal(0, 1, len(past))
    past["us_aqi"] = past.pm2_5 * 2
    past.loc[rng.random(len(past)) < 0.1, "us_aqi"] = np.nan
    past["european_aqi"] = past.pm2_5
    aqi = origin(to_spark(spark, past[["city", "lat", "lon", "ts", *schemas.AQI_MEASURES]]), schemas.SOURCE_ARCHIVE)
    return archive, forecast, aqi


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    """A warehouse after the end-to-end run."""
    house = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    result = pipelines.run(house, *feeds_of(spark), pipelines.instant(NOW), PLAN)
    return house, result


def test_ingest_overlap_and_rerun(spark, finished):
    house, _ = finished
    counts = {r["source"]: r["n"] for r in house.raw_weather.read().groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert counts == {schemas.SOURCE_ARCHIVE: 2 * (HOURS - 96), schemas.SOURCE_FORECAST: 2 * 96}
    before = rows(house.raw_weather.read())
    pipelines.ingest(house, *feeds_of(spark))
    assert rows(house.raw_weather.read()) == before
    assert house.raw_weather.read().schema == schemas.RAW_WEATHER


def test_preprocessed_table(finished):
    df = finished[0].preprocessed.read()
    assert {"lat_weather", "lat_aqi", "source_weather", "source_aqi", "hour", "pm2_5_rolling_3h",
            "temp_humidity_interaction"} <= set(df.columns)
    assert df.filter("us_aqi IS NULL OR temp IS NULL").count() == 0
    assert 0.9 * 2 * (HOURS - 72) < df.count() <= 2 * (HOURS - 72)


def test_feature_columns(finished):
    df = training.training_frame(finished[0].features.read(), PLAN)
    names = mlf.feature_columns(df)
    assert len(names) == 29
    assert {"lat_weather", "lon_aqi", "ozone", "aqi_lag_48", "is_weekend"} <= set(names)
    assert not {"us_aqi", "pm2_5", "pm10", "european_aqi", "is_train"} & set(names)
    shares = df.groupBy("city").agg(F.avg(F.col("is_train").cast("int")).alias("train"),
                                    F.avg(F.col("is_validation").cast("int")).alias("valid")).collect()
    assert all(abs(r["train"] - 0.8) < 0.01 and 0.05 < r["valid"] < 0.1 for r in shares)
    last_train = df.filter("is_train").groupBy("city").agg(F.max("ts").alias("t"))
    assert df.join(last_train, "city").filter("NOT is_train AND ts <= t").count() == 0


def test_trained_models(finished):
    models = registry.ModelRegistry(finished[0])
    comparison = {r["Model"]: r for r in models.read_comparison().collect()}
    assert set(comparison) == {"Random Forest", "XGBoost", "Gradient Boosting"}
    assert comparison["Random Forest"]["R2 (Test)"] > 0.6
    assert all(math.isfinite(v) for r in comparison.values() for v in list(r)[1:])
    row = models.best()
    assert len(row["feature_names"]) == 29 and row["hyperparameters"]
    model, row = models.get("Random Forest")
    weights = training.feature_importance(finished[0].spark, model, row["feature_names"]).collect()
    assert len(weights) == 29 and sum(w["importance"] for w in weights) == pytest.approx(1.0)
    assert weights[0]["importance"] == max(w["importance"] for w in weights)


def test_forecast(finished):
    house, result = finished
    df = result.rows
    assert df.count() == 2 * 72  # all hours ahead of now
    assert df.filter("predicted_aqi IS NULL OR aqi_category IS NULL").count() == 0
    lags = df.select(*[f"aqi_lag_{k}" for k in schemas.AQI_LAGS]).distinct().collect()
    assert all(len(set(r)) == 1 for r in lags) and len(lags) <= 2
    assert df.agg(F.max("pm2_5_rolling_3h")).first()[0] == 0.0
    assert result.daily.count() == 2 * 3
    assert {r["n"] for r in result.summary.collect()} == {72}
    assert rows(df.select("city", "ts")) == rows(house.predictions.read().select("city", "ts"))


def test_forecast_needs_rows_and_a_model(spark, finished, tmp_path):
    empty = Warehouse(spark, str(tmp_path))
    assert pipelines.predict_aqi_forecast(empty, pipelines.instant(NOW)) is None
    assert pipelines.engineer_and_store_features(empty) is None and pipelines.train(empty) is None
    assert pipelines.predict_aqi_forecast(finished[0], pipelines.instant("2030-01-01 00:00:00")) is None


def test_backtest_and_accuracy_report(finished):
    house, _ = finished
    models = registry.ModelRegistry(house)
    model, row = models.load(models.best())
    features, aqi = house.features.read(), house.raw_aqi.read()
    errors = scoring.backtest(features, aqi, model, row["feature_names"])
    assert errors.count() == 48
    page = reports.accuracy_report(aqi, models.models(), errors)
    known = [r for r in errors.collect() if r["actual"] is not None and r["city"] == "north"]
    mae = sum(abs(r["predicted"] - r["actual"]) for r in known) / len(known)
    got = {r["city"]: r["mae"] for r in page["error_summary"].collect()}
    assert got["north"] == pytest.approx(mae)
    assert page["recent"].count() == 40 and page["models"].count() == 3


def test_feature_metadata(finished):
    meta = {r["feature_name"]: r for r in FeatureStore(finished[0]).metadata().collect()}
    assert meta["temp"]["description"] == "Temperature in Celsius"
    assert meta["temp"]["statistics"]["count"] == finished[0].features.read().count()
    assert meta["hour"]["description"] is None and meta["hour"]["statistics"]["max"] == 23.0


def test_report_pages(finished):
    house, _ = finished
    prepared, predictions = house.preprocessed.read(), house.predictions.read()
    page = reports.data_analysis(prepared, columns=["temp", "pm2_5", "us_aqi"])
    assert all(df.count() > 0 for name, df in page.items() if name != "missing")
    page = reports.forecast_report(predictions)
    assert page["daily"].count() == 6 and page["headline"].count() == 2
    assert page["advice"].filter("advice IS NULL").count() == 0
    assert page["category_share"].groupBy("city").agg(F.sum("share").alias("s")).filter("abs(s - 1) > 1e-9").count() == 0
    page = reports.current_prediction(predictions, pipelines.instant("2024-01-28 05:20:00"))
    assert {r["ts"] for r in page["current"].collect()} == {dt.datetime(2024, 1, 28, 5)}
    assert page["first_24"].count() == 48
    page = reports.current_weather(house.raw_weather.read(), pipelines.instant("2024-01-20 05:50:00"))
    assert {r["ts"] for r in page["current"].collect()} == {dt.datetime(2024, 1, 20, 5)}
    assert page["today"].count() == 48
    performance = reports.model_performance(registry.ModelRegistry(house).read_comparison())
    assert performance["RMSE"].count() == 6


def test_align_features(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1, None)], "city string, ts timestamp_ntz, b int, c double")
    got = mlf.align_features(df, ["c", "missing", "b"])
    assert got.columns == ["city", "ts", "c", "missing", "b"]
    assert got.first()[2:] == (0.0, 0.0, 1.0)


def test_best_round():
    assert boosting.best_round([5, 4, 3, 3.5, 3.2, 2], 2) == 3  # stops before the later minimum
    assert boosting.best_round([5, 4, 3, 3.5, 3.2, 2], 3) == 6
    assert boosting.best_round([1.0], 30) == 1


def test_regularised_model_is_not_the_other_boosting(finished):
    models = registry.ModelRegistry(finished[0])
    model, row = models.get("XGBoost")
    assert isinstance(model.stages[-1], boosting.BoostedModel)
    assert {k: row["hyperparameters"][k] for k in ("alpha", "lambda_", "gamma", "min_child_weight", "column_sample")} == {
        "alpha": "1.0", "lambda_": "1.0", "gamma": "0.5", "min_child_weight": "5", "column_sample": "0.8"}
    assert 1 <= model.stages[-1].getNumTrees() <= PLAN.xgb_rounds


def test_scaler_stage(finished):
    df = finished[0].features.read().limit(50)
    scaled = training.assembly(["temp", "humidity"], scale=True).fit(df).transform(df)
    values = np.array([r["features"].toArray() for r in scaled.select("features").collect()])
    assert np.allclose(values.mean(axis=0), 0) and np.allclose(values.std(axis=0, ddof=1), 1)


def test_clean_keeps_rows_of_short_series(spark):
    archive, _, aqi = feeds_of(spark, 2)
    few = archive.filter("ts < TIMESTAMP_NTZ '2024-01-02 06:00:00'")
    df = pipelines.clean(few, aqi)
    assert df.count() == 60  # 30 rows per city: no outlier screening
    want = expr.drop_missing(df, "temp", "us_aqi")
    assert want.count() == 60
