"""Hourly weather and pollutant tables derived from the ``events`` and ``lineitem`` tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.functions.expr import floor_hour
from airloom.schemas import SOURCE_ARCHIVE, SOURCE_FORECAST, WEATHER_MEASURES
from airloom.sources.tables import latest_by_key

NOW = "2024-01-28 00:00:00"
FORECAST_START = "2024-01-27 00:00:00"


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.concat(F.lit("city_"), (F.col("user_id") % 3).cast("string")).alias("city"),
        floor_hour("ts").alias("ts"), "event_type",
        F.col("value").cast("decimal(18,2)").alias("v"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def _mean_of(kind: str) -> Column:
    hit = F.when(F.col("event_type") == kind, F.col("v"))
    return F.try_divide(F.sum(hit).cast("double"), F.count(hit))


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        readings(spark, sf_dir).filter(F.col("event_type").isin("click", "view", "purchase"))
        .groupBy("city", "ts")
        .agg(
            _mean_of("click").alias("temp"), _mean_of("view").alias("humidity"),
            (F.lit(1000.0) + F.sum("k").cast("double") / F.count("k") / 10).alias("pressure"),
            _mean_of("purchase").alias("wind_speed"), F.max("k").cast("double").alias("clouds"),
        )
    )


def weather_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append log of an archive and a forecast batch that share one day.

    Both batches come from one pass over the hourly rows: an hour in the shared day is
    emitted twice.
    """
    def batch(source: str, seq: int, shift: float) -> Column:
        return F.struct(F.lit(source).alias("source"), F.lit(seq).alias("seq"),
                        F.lit(shift).alias("shift"))

    archive, forecast = batch(SOURCE_ARCHIVE, 1, 0.0), batch(SOURCE_FORECAST, 2, 0.5)
    batches = (
        F.when(F.col("ts") < at(FORECAST_START), F.array(archive))
        .when(F.col("ts") < at(NOW), F.array(archive, forecast))
        .otherwise(F.array(forecast))
    )
    return weather_hourly(spark, sf_dir).withColumn("_b", F.explode(batches)).select(
        "city", "ts", (F.col("temp") + F.col("_b.shift")).alias("temp"),
        *[m for m in WEATHER_MEASURES if m != "temp"], "_b.source", "_b.seq",
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by_key(weather_feed(spark, sf_dir)).drop("seq")


def raw_aqi(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = F.sum("v").cast("double") / F.count("v")
    return (
        readings(spark, sf_dir)
        .filter(F.col("event_type").isin("error", "signup") & (F.col("ts") < at(NOW)))
        .groupBy("city", "ts")
        .agg(
            _mean_of("error").alias("pm10"), _mean_of("signup").alias("pm2_5"),
            (F.max("k") * 10).cast("double").alias("carbon_monoxide"),
            F.min("k").cast("double").alias("nitrogen_dioxide"),
            F.count(F.lit(1)).cast("double").alias("sulphur_dioxide"),
            F.sum("k").cast("double").alias("ozone"),
            F.when(F.hour("ts") % 5 != 0, mean).alias("us_aqi"),
            (mean * 0.6).alias("european_aqi"),
        )
    )


def aqi_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic stand-in for a scored forecast."""
    part = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("temp", "humidity", "wind_speed")}
    predicted = part["temp"] + 0.5 * part["humidity"] + 0.25 * part["wind_speed"]
    return raw_weather(spark, sf_dir).filter(
        (F.col("source") == SOURCE_FORECAST) & (F.col("ts") >= at(NOW))
    ).select(
        "city", "ts", *WEATHER_MEASURES, predicted.alias("predicted_aqi"),
        F.lit("Gradient Boosting").alias("model_name"),
    )


def readings_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily series per supplier: many rows for benchmarks."""
    def total(c: str) -> Column:
        return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")

    n = F.count(F.lit(1))
    return (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        .groupBy(
            F.concat(F.lit("city_"), F.col("l_suppkey").cast("string")).alias("city"),
            F.col("l_shipdate").cast("timestamp_ntz").alias("ts"),
        )
        .agg(
            total("l_quantity").alias("temp"),
            (total("l_extendedprice") / n / 210).alias("pm2_5"),
            (total("l_discount") * 100).alias("humidity"),
            F.when(F.sum("l_linenumber") % 5 != 0, total("l_tax") / n * 1000).alias("us_aqi"),
        )
    )
