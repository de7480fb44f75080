from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from airloom.functions import expr


def one(spark, value, ctype, column):
    df = spark.createDataFrame([(value,)], f"x {ctype}")
    return df.select(column.alias("y")).first()["y"]


@pytest.mark.parametrize("value, expected", [
    (0.0, 0.0), (12.0, 50.0), (12.05, None), (12.1, 51.0), (35.4, 100.0), (55.5, 151.0),
    (500.4, 500.0), (500.5, None), (-1.0, None), (None, None), (6.0, 25.0),
])
def test_pm25_to_aqi(spark, value, expected):
    got = one(spark, value, "double", expr.pm25_to_aqi("x"))
    assert got == pytest.approx(expected) if expected is not None else got is None


@pytest.mark.parametrize("value, expected", [
    (50.0, "Good"), (50.0001, "Moderate"), (100.0, "Moderate"), (150.0, "Unhealthy for Sensitive Groups"),
    (200.0, "Unhealthy"), (300.0, "Very Unhealthy"), (300.1, "Hazardous"), (-5.0, "Good"),
    (None, None), (float("nan"), None),
])
def test_aqi_category(spark, value, expected):
    assert one(spark, value, "double", expr.aqi_category("x")) == expected


def test_fill_us_aqi_only_where_missing(spark):
    df = spark.createDataFrame([(10.0, 12.0), (None, 12.0), (None, None)], "us_aqi double, pm2_5 double")
    assert [r[0] for r in df.select(expr.fill_us_aqi()).collect()] == [10.0, 50.0, None]


def test_parse_time(spark):
    df = spark.createDataFrame([("2024-01-01T05:00Z",), ("2024-01-01T05:00",)], "x string")
    assert {r[0] for r in df.select(expr.parse_time("x")).collect()} == {dt.datetime(2024, 1, 1, 5)}
    bad = spark.createDataFrame([("yesterday",)], "x string")
    with pytest.raises(PySparkException):
        bad.select(expr.parse_time("x")).collect()
    assert bad.select(expr.coerce_time("x")).first()[0] is None


def test_calendar(spark):
    sunday, monday = dt.datetime(2024, 1, 7, 17, 59), dt.datetime(2024, 1, 8, 6, 0)
    df = spark.createDataFrame([(sunday,), (monday,)], "ts timestamp_ntz")
    got = [r.asDict() for r in df.select(*[c.alias(n) for n, c in expr.calendar().items()]).collect()]
    assert got[0] == {"hour": 17, "day": 7, "month": 1, "day_of_week": 6, "is_weekend": 1, "is_rush_hour": 1}
    assert got[1] == {"hour": 6, "day": 8, "month": 1, "day_of_week": 0, "is_weekend": 0, "is_rush_hour": 0}


def test_epoch_seconds_ignores_session_zone(spark):
    at = dt.datetime(1969, 12, 31, 23, 59, 58)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Karachi")
    try:
        assert one(spark, at, "timestamp_ntz", expr.epoch_seconds("x")) == -2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_hour_floor_and_label(spark):
    at = dt.datetime(2024, 3, 1, 13, 45, 9)
    assert one(spark, at, "timestamp_ntz", expr.floor_hour("x")) == dt.datetime(2024, 3, 1, 13)
    assert one(spark, at, "timestamp_ntz", expr.hour_label("x")) == "2024-03-01 13:00"


def test_rounding_is_half_even(spark):
    assert one(spark, 2.25, "double", expr.round1("x")) == 2.2
    assert one(spark, 2.35, "double", expr.round1("x")) == pytest.approx(2.4)


def test_interactions_need_both_columns(spark):
    assert list(expr.interactions(["temp", "wind_speed", "pressure"])) == ["wind_pressure_interaction"]


def test_error_pct(spark):
    df = spark.createDataFrame([(12.0, 10.0), (5.0, 0.0), (5.0, -2.0)], "p double, a double")
    got = [r[0] for r in df.select(expr.error_pct("p", "a")).collect()]
    assert got == [pytest.approx(20.0), 0.0, 0.0]


def test_metric_and_status(spark):
    df = spark.createDataFrame([({"r2_test": 0.7},), ({"r2_test": 0.71},), ({},)], "metrics map<string,double>")
    got = df.select(expr.metric("r2_test"), expr.model_status(expr.metric("r2_test"))).collect()
    assert [tuple(r) for r in got] == [
        (0.7, "Needs improvement"), (0.71, "Good"), (0.0, "Needs improvement")]


def test_row_filters(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 3.0), (1.0, 2.0, None), (1.0, None, None), (None, None, None)], "a double, b double, c double")
    assert expr.drop_missing(df).count() == 1
    assert expr.drop_missing(df, "a").count() == 3
    assert expr.drop_sparse(df).count() == 2  # at least 2 of 3 columns


def test_time_filters(spark):
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(start + dt.timedelta(hours=h),) for h in range(24 * 5)], "ts timestamp_ntz")
    now = F.lit("2024-01-03 05:30:00").cast("timestamp_ntz")
    assert expr.not_before(df, now).count() == 24 * 5 - (48 + 6)
    assert expr.on_day(df, now).count() == 24
    assert expr.trailing_days(df, now, 2).agg(F.min("ts"), F.max("ts"), F.count("*")).first() == (
        start, dt.datetime(2024, 1, 2, 23), 48)


def test_clean_double(spark):
    assert one(spark, float("nan"), "double", expr.clean_double("x")) is None
    assert one(spark, 3, "int", expr.clean_double("x")) == 3.0
