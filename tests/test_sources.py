from __future__ import annotations

import datetime as dt
import json

import pytest
from helpers import rows
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from airloom import schemas
from airloom.sources import feeds, registry
from airloom.sources.metadata import FeatureStore
from airloom.sources.tables import ConcurrentWrite, Table, Warehouse, latest_by_key, preprocessed_or_joined, upsert

PAYLOAD = {"latitude": 27.7, "hourly": {
    "time": ["2024-01-01T00:00", "2024-01-01T01:00Z", "2024-01-01T02:00"], "temperature_2m": [1.5, 2]}}


def test_short_and_missing_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(PAYLOAD, indent=1))
    df = feeds.read_weather_archive(spark, str(tmp_path), "Town", lon=68.9, fetched_at=F.lit("2024-02-01 00:00:00").cast("timestamp"))
    assert df.columns == schemas.RAW_WEATHER.fieldNames()
    got = df.orderBy("ts").collect()
    assert [r["temp"] for r in got] == [1.5, 2.0, None]
    assert [r["clouds"] for r in got] == [None] * 3
    assert [r["ts"].hour for r in got] == [0, 1, 2]
    assert {(r["lat"], r["lon"], r["source"]) for r in got} == {(27.7, 68.9, "open-meteo-archive")}


def test_pollutants_and_forecast(spark, tmp_path):
    hourly = {"time": ["2024-01-01T00:00"], **{m: [float(i)] for i, m in enumerate(schemas.AQI_MEASURES)}}
    (tmp_path / "p.json").write_text(json.dumps({"hourly": hourly}))
    row = feeds.read_aqi(spark, str(tmp_path), "Town", lat=1.0, lon=2.0).first()
    assert [row[m] for m in schemas.AQI_MEASURES] == [float(i) for i in range(8)]
    assert feeds.read_weather_forecast(spark, str(tmp_path), "Town").first()["source"] == "open-meteo-forecast"


def test_empty_payload_has_no_rows(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"hourly": {"time": []}}))
    assert feeds.read_aqi(spark, str(tmp_path), "Town").count() == 0


def reading(city, hour, temp, day=1, month=1):
    return (city, dt.datetime(2024, month, day, hour), temp)


DDL = "city string, ts timestamp_ntz, temp double"


def test_upsert_last_writer_wins_with_nulls(spark):
    old = spark.createDataFrame([reading("a", 0, 1.0), reading("a", 1, 2.0)], DDL)
    new = spark.createDataFrame([(*reading("a", 1, 5.0), 1), (*reading("a", 1, None), 2), (*reading("b", 0, 9.0), 1)],
                                DDL + ", seq int")
    once = upsert(old, new, seq="seq")
    want = rows(spark.createDataFrame([reading("a", 0, 1.0), reading("a", 1, None), reading("b", 0, 9.0)], DDL))
    assert rows(once) == want
    assert rows(upsert(once, new, seq="seq")) == want  # applying it again changes nothing


def test_feed_order_decides(spark):
    archive = spark.createDataFrame([(*reading("a", 0, 1.0), "old")], DDL + ", source string")
    forecast = spark.createDataFrame([(*reading("a", 0, 2.0), "new")], DDL + ", source string")
    got = latest_by_key(feeds.combine_feeds(archive, forecast)).first()
    assert (got["temp"], got["source"]) == (2.0, "new")


def test_monthly_table_rewrites_only_touched_months(spark, tmp_path):
    schema = spark.createDataFrame([], DDL).schema
    table = Table(spark, str(tmp_path / "t"), schema, monthly=True)
    assert table.read().count() == 0 and table.is_empty()
    table.upsert(spark.createDataFrame([reading("a", 0, 1.0), reading("a", 0, 3.0, month=2)], DDL))

    def january():
        folder = tmp_path / "t" / table._folder("2024-01", table.snapshot()["parts"]["2024-01"])
        return {p: p.stat().st_mtime_ns for p in folder.iterdir()}

    before = january()
    table.upsert(spark.createDataFrame([reading("a", 0, 4.0, month=2), reading("a", 1, 5.0, month=3)], DDL))
    assert january() == before
    assert sorted(r["temp"] for r in table.read().collect()) == [1.0, 4.0, 5.0]
    since = table.read(since="2024-02-01 00:00:00", until="2024-03-01 00:00:00")
    assert [r["temp"] for r in since.collect()] == [4.0]
    plan = since._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_month" in plan
    assert table.lookup(temp=5.0).count() == 1
    assert [r["temp"] for r in table.overwrite(spark.createDataFrame([reading("z", 0, 8.0)], DDL)).collect()] == [8.0]


def failing(df, month):
    """Rows that cannot be computed in one month."""
    return df.withColumn("temp", F.when(F.month("ts") == month, F.raise_error(F.lit("no"))).otherwise(F.lit(0.0)))


def test_failed_writes_leave_every_month(spark, tmp_path, monkeypatch):
    table = Table(spark, str(tmp_path / "t"), monthly=True)
    data = spark.createDataFrame([reading("a", h, float(m * 10 + h), month=m) for m in (1, 2, 3) for h in range(3)], DDL)
    table.overwrite(data)
    before, state = rows(table.read()), table.snapshot()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # a task per month, so that others have written theirs
    try:
        for write in (table.upsert, table.overwrite):
            with pytest.raises(Exception, match="no"):
                write(failing(data, 2))
            assert rows(table.read()) == before and table.snapshot() == state
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    with monkeypatch.context() as m:
        m.setattr(Table, "_commit", lambda self, state: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.overwrite(data.filter("temp < 0"))
    assert rows(table.read()) == before
    assert len([n for n in table.vacuum() if n.startswith("data/")]) >= 1 and rows(table.read()) == before
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1


def test_of_two_writers_the_second_fails(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), monthly=True)
    table.overwrite(spark.createDataFrame([reading("a", 0, 1.0)], DDL))
    state = table.snapshot()
    table.upsert(spark.createDataFrame([reading("b", 0, 2.0)], DDL))
    with pytest.raises(ConcurrentWrite):
        table._write(spark.createDataFrame([reading("c", 0, 3.0)], DDL), state, None)
    assert rows(table.read(), "city") == [("a",), ("b",)]


def test_readers_keep_their_snapshot_and_old_files_go(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), monthly=True)
    table.overwrite(spark.createDataFrame([reading("a", 0, 1.0), reading("a", 0, 2.0, month=2)], DDL))
    old = table.read()
    table.overwrite(table.read().withColumn("temp", F.col("temp") + 10))
    assert rows(old, "temp") == [(1.0,), (2.0,)] and rows(table.read(), "temp") == [(11.0,), (12.0,)]
    for n in range(3):
        table.upsert(spark.createDataFrame([reading("a", 0, float(n), month=2)], DDL))
    assert rows(table.read(), "temp") == [(11.0,), (2.0,)]
    assert len(table._numbers()) == 2 and len(list((tmp_path / "t" / "data").iterdir())) == 3  # january, and two of february
    table.overwrite(table.read().filter("false"))
    assert table.exists() and table.is_empty() and table.read().columns == ["city", "ts", "temp"]


def test_lengths_are_counted_once_per_write(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), monthly=True)
    table.overwrite(spark.createDataFrame([reading(c, h, 1.0, month=m) for c in ("a", None) for m in (1, 2) for h in range(5)], DDL))
    table.upsert(spark.createDataFrame([reading("a", h, 2.0, month=2) for h in range(3, 8)] + [("a", None, 3.0)], DDL))
    want = [(None, 10, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1, 4)), ("a", 14, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1, 7))]
    assert rows(table.lengths()) == sorted(want, key=repr)
    side = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "lengths").rglob("*.parquet")}
    assert rows(table.lengths()) == sorted(want, key=repr) and rows(table.lengths(()), "rows") == [(24,)]
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "lengths").rglob("*.parquet") if p in side} == side
    files = table.lengths().inputFiles()
    assert files and all("/lengths/" in f for f in files)  # not the rows


def test_plain_table_rebuilds_itself(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    with pytest.raises(Exception):
        table.read()
    table.upsert(spark.createDataFrame([("a", 1)], "k string, v int"), keys=("k",))
    table.upsert(spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int"), keys=("k",))
    assert rows(table.read()) == [("a", 2), ("b", 3)]


def test_feature_store(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    store = FeatureStore(house)
    store.register_defaults()
    first = {r["feature_name"]: r for r in store.metadata().collect()}
    assert len(first) == 9 and first["temp"]["statistics"] is None
    data = spark.createDataFrame([reading("a", 0, 1.0), reading("a", 1, None), reading("a", 2, 4.0)], DDL)
    store.store(data)
    store.register_feature("temp", "Air temperature", "float", "sensor")
    after = {r["feature_name"]: r for r in store.metadata().collect()}
    assert set(after) == set(first) | {"city"}
    temp = after["temp"]
    assert (temp["description"], temp["source"]) == ("Air temperature", "sensor")
    assert temp["created_at"] == first["temp"]["created_at"] and temp["updated_at"] > first["temp"]["updated_at"]
    assert (temp["statistics"]["count"], temp["statistics"]["null_count"], temp["statistics"]["median"]) == (3, 1, 2.5)
    assert after["pm10"]["description"] == first["pm10"]["description"]
    assert after["city"]["statistics"]["mean"] is None
    assert store.features().count() == 3


def test_registry(spark, tmp_path):
    models = registry.ModelRegistry(Warehouse(spark, str(tmp_path)))
    assert models.best() is None and models.get("first") is None
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(20)], "x double, label double")
    fitted = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LinearRegression()]).fit(df)
    quality = {"r2_train": 1.0, "r2_test": 0.5, "mae_train": 0.0, "mae_test": 1.0, "rmse_train": 0.0, "rmse_test": 1.0}
    models.register("first", fitted, quality, ["x"], {"maxIter": 10})
    models.register("second", fitted, {**quality, "r2_test": 0.9}, ["x"])
    models.register("a third", fitted, {**quality, "r2_test": 0.9}, ["x"])
    assert models.best()["model_name"] == "a third"  # first name wins the tie
    models.register("second", fitted, {**quality, "r2_test": 0.95}, ["x"])
    assert models.models().count() == 3 and models.best()["model_name"] == "second"
    model, row = models.get("second")
    assert row["hyperparameters"] == {} and row["status"] == "active"
    assert model.transform(df).filter("x = 3").first()["prediction"] == pytest.approx(6.0)
    assert rows(registry.feature_list(models.models(), "first")) == [(1, "x")]
    comparison = models.write_comparison().collect()
    assert [r["Model"] for r in comparison][0] == "second" and comparison[0]["R2 (Test)"] == 0.95
    moved = models.models().filter("model_name = 'first'").withColumn("model_path", F.lit(str(tmp_path / "gone")))
    assert models.load(moved.first()) is None


def test_inactive_models_are_passed_over(spark):
    df = spark.createDataFrame([("a", {"r2_test": 0.9}, "retired"), ("b", {}, "active")],
                               "model_name string, metrics map<string,double>, status string")
    assert registry.best_model(df).first()["model_name"] == "b"
    assert registry.best_model(df, active_only=False).first()["model_name"] == "a"


def test_fallback_to_the_joined_tables(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    assert preprocessed_or_joined(house).count() == 0
    house.preprocessed.overwrite(spark.createDataFrame([reading("a", 0, 1.0)], DDL))
    assert preprocessed_or_joined(house).columns == ["city", "ts", "temp"]
