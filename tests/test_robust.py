"""NULL keys, NaN, infinities, broken payloads, undefined scores, and tables that survive a failed write."""

from __future__ import annotations

import json
import math

import pytest
from pyspark.sql import functions as F

from airloom.functions import expr
from airloom.operators import stats
from airloom.operators import timeseries as tsop
from airloom.operators.quantiles import exact_quantiles
from airloom.schemas import WEATHER_FIELDS
from airloom.sources import feeds, registry
from airloom.sources.tables import Table
from tests.helpers import rows


def payload(hours=2, **extra):
    return json.dumps({"latitude": 1.0, "longitude": 2.0, "hourly": {
        "time": [f"2024-01-01T{h:02d}:00" for h in range(hours)], "temperature_2m": [1.5, math.nan][:hours], **extra}})


def test_broken_files_raise_and_are_set_apart(spark, tmp_path):
    good, cut, error = payload(), payload()[:-7], '{"error": true}'
    for name, text in (("good", good), ("cut", cut)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text(text)
    read = feeds.read_weather_archive(spark, str(tmp_path / "good"), "x")
    assert [(r["temp"], r["humidity"]) for r in read.orderBy("ts").collect()] == [(1.5, None), (None, None)]
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        feeds.read_weather_archive(spark, str(tmp_path / "cut"), "x").collect()
    texts = spark.createDataFrame([(1, good), (2, cut), (3, error), (4, None), (5, "")], "id int, payload string")
    accepted, rejected = feeds.split_payloads(texts, "payload", WEATHER_FIELDS)
    assert rows(accepted, "id") == [(1,)] and rows(rejected, "id") == [(2,), (3,), (4,), (5,)]
    with pytest.raises(Exception, match="without hourly times"):
        feeds.decode_text(texts.filter("id = 3"), "payload", WEATHER_FIELDS).collect()


def test_a_failed_rewrite_leaves_the_table(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    assert not table.exists()
    table.overwrite(spark.range(3))
    bad = spark.range(5).withColumn("id", F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        table.overwrite(bad)
    assert rows(table.read()) == [(0,), (1,), (2,)]
    table.overwrite(table.read().union(spark.range(7, 9)))
    assert rows(table.read()) == [(0,), (1,), (2,), (7,), (8,)]


def test_upserts_without_times_and_first_writers(spark, tmp_path):
    table = Table(spark, str(tmp_path / "m"), monthly=True)
    for city, n in (("a", 1), ("b", 2), ("a", 3)):
        table.upsert(spark.createDataFrame([(city, None, n)], "city string, ts timestamp_ntz, n int"))
    assert rows(table.read(), "city", "n") == [("a", 3), ("b", 2)]
    first = Table(spark, str(tmp_path / "f"))
    for batch in ([("a", 5), ("a", 4), ("b", 9)], [("a", 1), ("c", 2)]):
        first.upsert(spark.createDataFrame(batch, "city string, n int"), keys=("city",), seq="n", keep="first")
    assert rows(first.read(), "city", "n") == [("a", 4), ("b", 9), ("c", 2)]


@pytest.mark.parametrize("interior", [2, 10_000])
def test_quantiles_of_nan_infinities_and_null_keys(spark, interior):
    inf = math.inf
    values = [("a", float(v)) for v in range(9)] + [("a", math.nan), ("a", inf), ("a", -inf), (None, 1.0), (None, 3.0), ("n", math.nan)]
    df = spark.createDataFrame(values, "city string, x double")
    got = {r["city"]: r["x"] for r in exact_quantiles(df, ["x"], [0.0, 0.5, 1.0], keys=("city",), max_interior=interior).collect()}
    assert got == {"a": [-inf, 4.0, inf], None: [1.0, 2.0, 3.0], "n": None}


@pytest.mark.parametrize("split", [True, False])
def test_nameless_series_keep_their_rows(spark, split):
    df = spark.createDataFrame([(c, h, float(h) if h % 2 else None) for c in ("a", None) for h in range(60)], "city string, h int, x double")
    df = df.select("city", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("h"))).alias("ts"), "x")
    assert tsop.forward_fill(df, ["x"], split=split).filter("x is not null").count() == 118
    assert tsop.rolling_mean(df, ["x"], by="time", split=split).count() == 120
    lagged = tsop.add_lags(df, "x", (1,), by="time", split=split)
    assert lagged.filter("aqi_lag_1 is not null").count() == 58 and lagged.count() == 120
    marked = tsop.chrono_marks(df, {"all": 1.0, "half": 0.5}, split=split)
    assert marked.filter("all").count() == 120 and marked.filter("half").count() == 60


def test_instants_below_a_second(spark):
    df = spark.sql("""SELECT 'a' AS city, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) AS ts, v
        FROM VALUES (0.0, 10.0D), (7200.5, 20.0D), (7200.9, 30.0D) AS t(s, v)""")
    for split in (True, False):
        got = tsop.rolling_mean(df, ["v"], by="time", split=split).orderBy("ts").collect()
        assert [r["v_rolling_3h"] for r in got] == [10.0, 20.0, 25.0]


def test_undefined_scores_do_not_win(spark):
    models = spark.createDataFrame(
        [("flat", {"r2_test": math.nan}, "active"), ("good", {"r2_test": 0.9}, "active"), ("none", {}, "active")],
        "model_name string, metrics map<string,double>, status string")
    assert registry.best_model(models).first()["model_name"] == "good"
    status = {r["model_name"]: r["status"] for r in registry.model_report(models).collect()}
    assert status == {"flat": "Needs improvement", "good": "Good", "none": "Needs improvement"}
    assert registry.comparison_rows(models).first()["Model"] == "good"


def test_profiles_and_correlations_skip_nan(spark):
    data = [(None if i % 2 else "a", float(i), 2.0 * i if i != 3 else math.nan) for i in range(20)]
    df = spark.createDataFrame(data, "city string, x double, y double")
    r = {(a, b): v for a, b, v in rows(stats.corr_matrix(df, ["x", "y"]), "col_a", "col_b", "r")}
    assert math.isclose(r["x", "y"], 1.0)
    profile = {(p["city"], p["feature_name"]): p for p in stats.feature_profile(df, keys=("city",), order="none").collect()}
    assert profile[None, "y"]["null_count"] == 1 and profile[None, "y"]["median"] is not None
    assert df.select(expr.epoch_micros(F.lit("1970-01-01 00:00:01.000250").cast("timestamp_ntz"))).first()[0] == 1_000_250
