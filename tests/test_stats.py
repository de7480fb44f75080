from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from helpers import gappy, same, to_spark
from pyspark.sql import functions as F

from airloom.operators import joins, stats
from airloom.plans import reports


@pytest.fixture(scope="module")
def data(spark):
    pdf = gappy(4)
    pdf["flat"] = 27.7
    return pdf, to_spark(spark, pdf).cache()


def test_profile_and_describe(data):
    pdf, df = data
    got = {r["feature_name"]: r for r in stats.feature_profile(df).collect()}
    assert set(got) == {"city", "x", "y", "flat"}
    assert got["city"]["count"] == len(pdf) and got["city"]["mean"] is None
    for c in ("x", "y"):
        assert got[c]["null_count"] == int(pdf[c].isna().sum())
        for name, value in (("mean", pdf[c].mean()), ("std", pdf[c].std()), ("min", pdf[c].min()),
                            ("max", pdf[c].max()), ("median", pdf[c].median())):
            assert same(got[c][name], float(value)), (c, name)
    described = {r["column_name"]: r for r in stats.describe(df, ["x", "y"]).collect()}
    for c in ("x", "y"):
        want = pdf[c].describe()
        for ours, theirs in (("count", "count"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%")):
            assert same(float(described[c][ours]), float(want[theirs]))


def test_profile_by_city_and_approximate(data):
    pdf, df = data
    for r in stats.feature_profile(df.select("city", "ts", "x"), keys=("city",)).collect():
        assert same(r["median"], float(pdf[pdf.city == r["city"]].x.median()))
    approx = stats.feature_profile(df.select("ts", "x"), approx=True).first()
    assert abs(approx["median"] - pdf.x.median()) < 0.5


def test_profile_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    got = stats.feature_profile(df).first()
    assert (got["count"], got["null_count"], got["mean"], got["median"]) == (2, 2, None, None)


def test_missing_report(data):
    pdf, df = data
    got = [(r["column_name"], r["missing"]) for r in stats.missing_report(df).collect()]
    want = pdf.isna().sum()
    assert got == sorted(((c, n) for c, n in want.items() if n), key=lambda t: (-t[1], t[0]))


def test_correlation(data):
    pdf, df = data
    want = pdf[["x", "y", "flat"]].corr()
    for r in stats.corr_matrix(df, ["x", "y", "flat"]).collect():
        assert same(r["r"], float(want.loc[r["col_a"], r["col_b"]])), r
    target = [(r["column_name"], r["r"]) for r in stats.corr_target(df, "x", ["x", "y", "flat"]).collect()]
    assert target[0][0] == "x" and target[-1] == ("flat", None)


def test_correlation_without_common_rows(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (None, 1.0)], "a double, b double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in stats.corr_matrix(df).collect()}
    assert got[("a", "b")] is None and got[("b", "b")] is None and got[("a", "a")] == pytest.approx(1)
    assert len(got) == 4


def test_correlation_where_a_pair_is_constant(spark):
    rows = [(1.1, 1.0, 5.0), (1.1, 2.0, 6.0), (1.1, 3.0, 5.5), (7.0, None, 9.0), (8.0, None, 9.5)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    got = {(r["col_a"], r["col_b"]): r["r"] for r in stats.corr_matrix(df).collect()}
    want = df.toPandas().corr()
    assert got[("a", "b")] is None  # a does not vary where b is known
    for a, b in (("a", "c"), ("b", "c"), ("b", "b")):
        assert same(got[(a, b)], float(want.loc[a, b]))


def test_histogram(data):
    pdf, df = data
    values = pdf.x.dropna()
    counts, _ = np.histogram(values, bins=50)
    got = {r["bin"]: r["n"] for r in stats.histogram(df, "x", 50).collect()}
    assert sum(got.values()) == len(values)
    assert sum(abs(got.get(i, 0) - n) for i, n in enumerate(counts)) <= 2  # rounding at bin edges
    flat = stats.histogram(df, "flat", 50).collect()
    assert [(r["bin"], r["n"]) for r in flat] == [(0, len(pdf))]
    assert stats.histogram(df.limit(0), "x").count() == 0


def test_box_summary(data):
    pdf, df = data
    got = {r["column_name"]: r for r in stats.box_summary(df, ["x"]).collect()}["x"]
    q1, q3 = pdf.x.quantile([0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = pdf.x[(pdf.x >= low) & (pdf.x <= high)]
    assert same(got["whisker_low"], float(inside.min())) and same(got["whisker_high"], float(inside.max()))
    assert got["outliers"] == pdf.x.notna().sum() - len(inside)


def test_recent_trend_direction(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("up", start + dt.timedelta(hours=i), float(i)) for i in range(200)]
    rows += [("down", start + dt.timedelta(hours=i), float(-i)) for i in range(10)]
    df = spark.createDataFrame(rows, "city string, ts timestamp_ntz, us_aqi double")
    got = {r["city"]: r for r in stats.recent_trend(df).collect()}
    assert got["up"]["trend"] == "UP" and got["down"]["trend"] == "DOWN"
    assert got["up"]["min"] == 32.0 and got["up"]["mean_recent"] == pytest.approx(187.5)


def test_headline_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("a", 4.0), ("b", 9.0), (None, 5.0), (None, 6.0), (None, 7.0)],
                               "aqi_category string, predicted_aqi double")
    got = stats.headline_metrics(df).first()
    assert (got["most_common"], got["max_aqi"], got["min_aqi"]) == ("a", 9.0, 1.0)
    assert got["avg_aqi"] == pytest.approx(34 / 7)
    share = {r["aqi_category"]: r["share"] for r in stats.category_share(df).collect()}
    assert share == {"a": 0.5, "b": 0.5}


def test_daily_summary_category_of_the_rounded_mean(spark):
    day = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", day, 50.04), ("a", day + dt.timedelta(hours=1), 50.04)],
                               "city string, ts timestamp_ntz, predicted_aqi double")
    got = stats.daily_summary(df).first()
    assert (got["day"], got["avg_aqi"], got["category"]) == (day.date(), 50.0, "Good")


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (4.0, 5.0), (None, 1.0)], "predicted double, actual double")
    got = stats.regression_metrics(df).first()
    actual, error = np.array([1.0, 3.0, 5.0]), np.array([0.0, -1.0, -1.0])
    assert got["n"] == 3 and got["mae"] == pytest.approx(2 / 3)
    assert got["rmse"] == pytest.approx(np.sqrt((error ** 2).mean()))
    assert got["r2"] == pytest.approx(1 - (error ** 2).sum() / ((actual - 3) ** 2).sum())
    flat = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "predicted double, actual double")
    assert stats.regression_metrics(flat).first()["r2"] is None


def test_melt(spark):
    df = spark.createDataFrame([("m", 0.9, 0.8, 1.0, 2.0, 3.0, 4.0)],
                               "Model string, `R2 (Train)` double, `R2 (Test)` double, `MAE (Train)` double,"
                               " `MAE (Test)` double, `RMSE (Train)` double, `RMSE (Test)` double")
    assert sorted(tuple(r) for r in stats.melt_metrics(df, "MAE").collect()) == [
        ("m", "MAE (Test)", 2.0), ("m", "MAE (Train)", 1.0)]


def test_counts_shape_and_overview(spark, data):
    _, df = data
    shape = stats.shape_report(df).first()
    assert shape["column_count"] == 5 and shape["column_names"] == "city, ts, x, y, flat"
    aqi = df.select("city", "ts", F.col("x").alias("us_aqi"))
    models = spark.createDataFrame([("m",)], "model_name string")
    page = reports.overview(aqi, df, models)
    assert {r["table_name"]: r["n"] for r in page["counts"].collect()}["model_registry"] == 1
    assert page["last_week"].count() == sum(min(168, n) for n in data[0].groupby("city").size())


def test_join_suffixes_and_dimension_joins(spark):
    w = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1.0, 27.0, "s1")],
                              "city string, ts timestamp_ntz, temp double, lat double, source string")
    a = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 12.05, 27.0, "s2")],
                              "city string, ts timestamp_ntz, pm2_5 double, lat double, source string")
    got = joins.merge_readings(w, a)
    assert set(got.columns) == {"city", "ts", "temp", "pm2_5", "lat_weather", "lat_aqi",
                                "source_weather", "source_aqi"}
    assert joins.pm25_range_join(got).first()["aqi_from_pm25"] is None
    values = spark.createDataFrame([(50.0,), (50.5,), (301.0,), (None,)], "v double")
    zones = [r["zone"] for r in joins.category_join(values, "v").orderBy(F.col("v").asc_nulls_last()).collect()]
    assert zones == ["0-50", "51-100", "301+", None]


def test_last_known_defaults(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "city string, x int")
    aqi = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 10.0), ("a", dt.datetime(2024, 1, 2), 20.0),
                                 ("b", dt.datetime(2024, 1, 2), None)], "city string, ts timestamp_ntz, us_aqi double")
    got = {r["city"]: (r["l1"], r["l2"]) for r in joins.last_known(df, aqi, names=["l1", "l2"]).collect()}
    assert got == {"a": (20.0, 20.0), "b": (50.0, 50.0), "c": (50.0, 50.0)}
    nameless = joins.last_known(df.withColumn("city", F.nullif("city", F.lit("a"))),
                                aqi.withColumn("city", F.nullif("city", F.lit("a"))), names=["l"])
    assert {r["city"]: r["l"] for r in nameless.collect()} == {None: 20.0, "b": 50.0, "c": 50.0}
