"""Decode columnar JSON payloads (parallel hourly arrays) into one row per hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.functions.expr import clean_double, parse_time
from airloom.schemas import (
    AQI_FIELDS, SOURCE_ARCHIVE, SOURCE_FORECAST, WEATHER_FIELDS, payload_schema,
)


def decode_hourly(payloads: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Explode ``hourly.time`` and pick the same index from every measure array.

    A short or absent array and NaN yield NULL. A payload without times raises. Columns other
    than ``hourly`` are kept.
    """
    others = [c for c in payloads.columns if c != "hourly"]
    times = F.when(F.col("hourly.time").isNull(), F.raise_error(F.lit("payload without hourly times")))
    return payloads.select(
        *others, "hourly", F.posexplode(times.otherwise(F.col("hourly.time"))).alias("_i", "_time")
    ).select(
        *others, parse_time("_time").alias("ts"),
        *[clean_double(F.get(f"hourly.{wire}", "_i")).alias(name) for wire, name in fields.items()],
    )


def _with_origin(
    rows: DataFrame, fields: dict[str, str], city: Column, source: str,
    lat: float | None, lon: float | None, fetched_at: Column | None,
) -> DataFrame:
    def place(given: float | None, column: str) -> Column:
        return F.col(column) if given is None else F.lit(float(given))

    return rows.select(
        city.alias("city"), place(lat, "latitude").alias("lat"), place(lon, "longitude").alias("lon"),
        "ts", *fields.values(), F.lit(source).alias("source"),
        (F.current_timestamp() if fetched_at is None else fetched_at).alias("fetched_at"),
    )


def _read(spark, path, fields, city, source, lat, lon, fetched_at, multiline) -> DataFrame:
    reader = spark.read.schema(payload_schema(fields))
    payloads = reader.json(path, multiLine=multiline, mode="FAILFAST")  # a broken file is an error
    city = F.lit(city) if isinstance(city, str) else city
    return _with_origin(
        decode_hourly(payloads, fields), fields, city, source, lat, lon, fetched_at
    )


def read_weather_archive(
    spark: SparkSession, path: str, city: str | Column, *, lat: float | None = None,
    lon: float | None = None, fetched_at: Column | None = None, multiline: bool = True,
) -> DataFrame:
    """Landed weather-archive payloads as ``raw_weather`` rows.

    Coordinates default to those in the payload; ``city`` may be an expression, such as a
    partition column or a part of ``input_file_name()``. A file holds one payload, or one
    per line with ``multiline=False``, in which case large files are split between tasks.
    """
    return _read(spark, path, WEATHER_FIELDS, city, SOURCE_ARCHIVE, lat, lon, fetched_at, multiline)


def read_weather_forecast(
    spark: SparkSession, path: str, city: str | Column, *, lat: float | None = None,
    lon: float | None = None, fetched_at: Column | None = None, multiline: bool = True,
) -> DataFrame:
    """Landed weather-forecast payloads as ``raw_weather`` rows."""
    return _read(spark, path, WEATHER_FIELDS, city, SOURCE_FORECAST, lat, lon, fetched_at, multiline)


def read_aqi(
    spark: SparkSession, path: str, city: str | Column, *, lat: float | None = None,
    lon: float | None = None, fetched_at: Column | None = None, multiline: bool = True,
) -> DataFrame:
    """Landed pollutant payloads as ``raw_aqi`` rows."""
    return _read(spark, path, AQI_FIELDS, city, SOURCE_ARCHIVE, lat, lon, fetched_at, multiline)


def decode_text(payloads: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """Decode payloads held as JSON text in a column; other columns are kept. A broken payload
    raises; ``split_payloads`` sets such ones apart first."""
    others = [c for c in payloads.columns if c != column]
    parsed = F.from_json(column, payload_schema(fields), {"mode": "FAILFAST"})
    return decode_hourly(payloads.select(*others, parsed["hourly"].alias("hourly")), fields)


def split_payloads(payloads: DataFrame, column: str, fields: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): payloads that parse and hold times, and all others, NULL included."""
    schema = payload_schema(fields).add("_broken", "string")
    parsed = F.from_json(column, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    good = F.coalesce(parsed["_broken"].isNull() & parsed["hourly"]["time"].isNotNull(), F.lit(False))
    return payloads.filter(good), payloads.filter(~good)


def combine_feeds(archive: DataFrame, forecast: DataFrame) -> DataFrame:
    """Both feeds as one append log; the forecast is the later batch."""
    return archive.withColumn("seq", F.lit(1)).unionByName(forecast.withColumn("seq", F.lit(2)))
