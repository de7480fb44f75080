from __future__ import annotations

import datetime as dt
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from helpers import assert_equals_pandas, gappy, rows, to_spark
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airloom.operators import joins, series
from airloom.operators import timeseries as tsop
from airloom.session import scratch_dir
from airloom.sources.tables import Table

DAY = 86400
# Each variant must give the same rows: one window per series, and cuts of several sizes.
VARIANTS = [
    {"split": False}, {"split": True}, {"split": True, "bucket_seconds": DAY},
    {"split": True, "bucket_seconds": 3600},
]


@pytest.fixture(scope="module")
def data(spark):
    pdf = gappy()
    return pdf, to_spark(spark, pdf).cache()


@pytest.mark.parametrize("how", VARIANTS)
def test_fills(data, how):
    pdf, df = data
    by_city = pdf.groupby("city")
    for fill, expected in ((tsop.forward_fill, by_city[["x", "y"]].ffill()),
                           (tsop.backward_fill, by_city[["x", "y"]].bfill())):
        want = pdf.assign(**{c: expected[c] for c in ("x", "y")})
        assert_equals_pandas(fill(df, **how), want, ["x", "y"])


@pytest.mark.parametrize("how", VARIANTS)
def test_fill_then_zero(spark, data, how):
    pdf = data[0].copy()
    pdf.loc[pdf.city == "b", "x"] = np.nan
    df = to_spark(spark, pdf)
    filled = pdf.groupby("city")[["x", "y"]].transform(lambda s: s.ffill().bfill()).fillna(0)
    assert_equals_pandas(
        tsop.fill_then_zero(df, ["x", "y"], **how), pdf.assign(x=filled.x, y=filled.y), ["x", "y"])


@pytest.mark.parametrize("how", VARIANTS)
def test_fill_then_median(spark, data, how):
    pdf = data[0].copy()
    pdf.loc[pdf.city == "b", "x"] = np.nan
    df = to_spark(spark, pdf)
    filled = pdf.groupby("city")[["x", "y"]].transform(lambda s: s.ffill().bfill())
    filled = filled.fillna(filled.median())
    got = tsop.fill_then_median(df, ["x", "y"], **how)
    assert_equals_pandas(got, pdf.assign(x=filled.x, y=filled.y), ["x", "y"])


def test_fill_median_of_nothing_stays_missing(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), None)], "city string, ts timestamp_ntz, x double")
    assert tsop.fill_then_median(df, ["x"]).first()["x"] is None


@pytest.mark.parametrize("how", [*VARIANTS, {"split": True, "bucket_seconds": 3600, "block_rows": 48},
                                 {"split": True, "bucket_seconds": DAY, "block_rows": 49},
                                 {"split": True, "bucket_seconds": 40 * DAY, "block_rows": 60}])
def test_lags_and_rolling(data, how):
    pdf, df = data
    lags = (1, 3, 6, 12, 24, 48)
    want = pdf.copy()
    for k in lags:
        want[f"aqi_lag_{k}"] = want.groupby("city")["x"].shift(k)
    want["x_rolling_3h"] = want.groupby("city")["x"].transform(lambda s: s.rolling(3, min_periods=1).mean())
    assert_equals_pandas(tsop.add_lags(df, "x", lags, **how), want, [f"aqi_lag_{k}" for k in lags])
    assert_equals_pandas(tsop.rolling_mean(df, ["x"], **how), want, ["x_rolling_3h"])


@settings(max_examples=8, deadline=None)
@given(seed=st.integers(0, 10**6), block=st.integers(5, 40), hours=st.integers(1, 30))
def test_blocks_of_any_size(spark, seed, block, hours):
    pdf = gappy(seed, cities=("a", "b"), hours=120)
    want = pdf.copy()
    want["aqi_lag_5"] = want.groupby("city")["x"].shift(5)
    got = tsop.add_lags(to_spark(spark, pdf), "x", [5], split=True, block_rows=block, bucket_seconds=hours * 3600)
    assert_equals_pandas(got, want, ["aqi_lag_5"])


def test_block_must_cover_the_frame(data):
    with pytest.raises(ValueError):
        tsop.add_lags(data[1], "x", [48], block_rows=10)


@pytest.mark.parametrize("bucket", [7200, DAY, 30 * DAY])
def test_time_based_windows(data, bucket):
    pdf, df = data
    want = pdf.copy()
    want["x_rolling_3h"] = np.nan
    for _, part in pdf.groupby("city"):
        rolled = part.set_index("ts")["x"].rolling("3h", min_periods=1).mean()
        want.loc[part.index, "x_rolling_3h"] = rolled.values
    for split in (True, False):
        got = tsop.rolling_mean(df, ["x"], by="time", bucket_seconds=bucket, split=split)
        assert_equals_pandas(got, want, ["x_rolling_3h"])
    lagged = tsop.add_lags(df, "x", [1, 24], by="time")
    for k in (1, 24):
        moved = pdf[["city", "ts", "x"]].assign(ts=pdf.ts + pd.Timedelta(hours=k)).rename(columns={"x": f"aqi_lag_{k}"})
        assert_equals_pandas(lagged, pdf.merge(moved, on=["city", "ts"], how="left"), [f"aqi_lag_{k}"])


@pytest.mark.parametrize("split", [True, False, None])
def test_means_over_time_do_not_slide(spark, split):
    """Frames end inside, at and beyond blocks; equal and missing times, missing and odd values."""
    rng = np.random.default_rng(5)
    micros = [int(x) for x in rng.integers(-9_000, 30_000, 150)] + [-7200, 0, 0, 3600, 7200, 7200, 14_400, 21_600]
    values = [None if i % 9 == 0 else float(x) for i, x in enumerate(rng.integers(0, 1000, len(micros)))]
    values[17], values[40] = float("nan"), float("inf")
    rows = [(i, ["a", "b", None][i % 3], m * 1_000_000 + (i % 4) * 250_000, v) for i, (m, v) in enumerate(zip(micros, values))]
    rows += [(900 + i, "a", None, v) for i, v in enumerate((1.0, None, 5.0))]
    df = spark.createDataFrame(rows, "id int, city string, at long, x double").select(
        "id", "city", F.timestamp_micros("at").cast("timestamp_ntz").alias("ts"), "x", F.col("id").alias("n"),
        F.lit("1.50").cast("decimal(9,2)").alias("d"))
    got_rows = tsop.rolling_mean(df, ["x", "d", "n"], by="time", split=split)
    assert got_rows.columns == ["id", "city", "ts", "x", "n", "d", "x_rolling_3h", "d_rolling_3h", "n_rolling_3h"]
    assert got_rows.schema["d_rolling_3h"].dataType.simpleString() == "decimal(13,6)"
    got = {r["id"]: r for r in got_rows.collect()}
    assert len(got) == len(rows)
    for i, city, at, x in rows:
        known = [v for _, c, t, v in rows if c == city and v is not None and (
            t is None if at is None else t is not None and at - 7_200_000_000 <= t <= at)]
        want = sum(known) / len(known) if known else None
        mean = got[i]["x_rolling_3h"]
        assert mean is None if want is None else mean == pytest.approx(want, nan_ok=True)
        assert got[i]["x"] == pytest.approx(x, nan_ok=True) and float(got[i]["d_rolling_3h"]) == 1.5
    # A sliding frame is summed anew for every row.
    assert "-7200000000" not in got_rows._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("how", VARIANTS)
def test_sequences(data, how):
    pdf, df = data
    got = tsop.sequence_windows(df, ["x", "y"], "y", steps=24, **how).collect()
    sizes = pdf.groupby("city").size()
    assert len(got) == sum(max(0, n - 24) for n in sizes)
    lookup = {c: p.reset_index(drop=True) for c, p in pdf.groupby("city")}
    for r in got[::37]:
        part = lookup[r["city"]]
        i = part.index[part.ts == pd.Timestamp(r["ts"])][0]
        want = [None if pd.isna(v) else v for v in part.x[i - 24:i]]
        assert [s["x"] for s in r["sequence"]] == want


@pytest.mark.parametrize("how", VARIANTS)
def test_positions(data, how):
    pdf, df = data
    want = pdf.assign(p=pdf.groupby("city").cumcount(), n=pdf.groupby("city")["ts"].transform("size"))
    assert_equals_pandas(series.with_position(df, "p", total="n", **how), want, ["p", "n"])


@pytest.mark.parametrize("bucket", [3600, DAY, 30 * DAY])
def test_chrono_split_partitions_the_input(data, bucket):
    pdf, df = data
    got = tsop.chrono_split(df, bucket_seconds=bucket, split=True)
    assert rows(got) == rows(tsop.chrono_split(df, split=False))
    n = pdf.groupby("city")["ts"].transform("size")
    want = pdf.assign(is_train=pdf.groupby("city").cumcount() < (n * 0.8).astype(int))
    assert_equals_pandas(got, want, ["is_train"])


def test_chrono_split_of_one_row_and_whole_table(spark, data):
    one = spark.createDataFrame([("a", dt.datetime(2024, 1, 1))], "city string, ts timestamp_ntz")
    assert [r["is_train"] for r in tsop.chrono_split(one).collect()] == [False]
    single = data[1].filter("city = 'a'")
    assert rows(tsop.chrono_split(single, keys=())) == rows(tsop.chrono_split(single))


@pytest.mark.parametrize("n", [3, 6, 23, 60])
def test_cv_folds(spark, n):
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", start + dt.timedelta(hours=i)) for i in range(n)], "city string, ts timestamp_ntz")
    plain = [r["fold"] for r in tsop.cv_folds(df, split=False).orderBy("ts").collect()]
    got = [r["fold"] for r in tsop.cv_folds(df, bucket_seconds=DAY, split=True).orderBy("ts").collect()]
    assert plain == got
    size = n // 6
    want = [0] * (n - 5 * size) + [k for k in range(1, 6) for _ in range(size)]
    assert got == want


def test_first_last_latest(data):
    pdf, df = data
    want = pdf.groupby("city").tail(20)
    assert rows(tsop.last_rows(df, 20), "city", "ts") == sorted(
        ((c, t.to_pydatetime()) for c, t in zip(want.city, want.ts)), key=repr)
    assert tsop.first_rows(df, 7).count() == 21
    assert tsop.last_rows(df, 5, keys=()).count() == 5
    for r in tsop.latest(df, ["x"]).collect():
        last = pdf[pdf.city == r["city"]].iloc[-1]
        assert r["ts"] == last.ts and (r["x"] == last.x or (r["x"] is None and pd.isna(last.x)))


@pytest.mark.parametrize("how", VARIANTS)
@pytest.mark.parametrize("tolerance", [None, 5400])
def test_nearest_join(spark, data, how, tolerance):
    pdf, df = data
    rng = np.random.default_rng(5)
    start = pd.Timestamp("2023-12-31")
    probes = pd.DataFrame({
        "id": range(150), "city": rng.choice(["a", "b", "nowhere"], 150),
        "ts": [start + pd.Timedelta(minutes=int(m)) for m in rng.integers(0, 27000, 150)]})
    probes.loc[:30, "ts"] = pd.Timestamp("2024-01-05 07:30")  # many probes at one instant
    got = {r["id"]: r["near_ts"] for r in joins.nearest_join(
        to_spark(spark, probes), df.select("city", "ts", "x"), tolerance_seconds=tolerance, **how).collect()}
    assert len(got) == 150
    for p in probes.itertuples():
        known = pdf[pdf.city == p.city].ts
        best = min(known, key=lambda t: (abs(t - p.ts), t), default=None)
        if best is not None and tolerance is not None and abs(best - p.ts) > pd.Timedelta(seconds=tolerance):
            best = None
        assert got[p.id] == (best.to_pydatetime() if best is not None else None)


@pytest.mark.parametrize("how", [*VARIANTS, {"split": None}])
def test_nearest_join_of_nameless_series_and_odd_times(spark, how, monkeypatch):
    monkeypatch.setattr(joins, "BLOCK_ROWS", 10)  # so that probes of one instant are dealt to several tasks
    at = dt.datetime(2024, 1, 1)
    readings = spark.createDataFrame([(None, at, 1.0, "n"), (None, at + dt.timedelta(hours=40), None, "m"), ("a", None, 9.0, "x")],
                                     "city string, ts timestamp_ntz, x double, text string")
    probes = spark.createDataFrame(
        [(i, None, at + dt.timedelta(hours=30)) for i in range(95)] + [(100, None, None), (101, "a", at), (102, None, at)],
        "id int, city string, ts timestamp_ntz")
    got = {r["id"]: tuple(r)[1:] for r in joins.nearest_join(probes, readings, prefix="r_", **how).collect()}
    assert len(got) == 98
    later = at + dt.timedelta(hours=40)
    assert {got[i] for i in range(95)} == {(None, at + dt.timedelta(hours=30), later, None, "m")}
    assert got[100][2:] == (None, None, None) and got[101] == ("a", at, None, None, None) and got[102][2:] == (at, 1.0, "n")


def test_nearest_join_shuffles_rows_once(spark, data):
    df = data[1]
    probes = df.select("city", "ts")
    plain = joins.nearest_join(probes, df, split=False)._jdf.queryExecution().executedPlan().toString()
    assert plain.count("Exchange hashpartitioning") == 1 and "Join" not in plain
    cut = joins.nearest_join(probes, df, split=True)._jdf.queryExecution().executedPlan().toString()
    assert cut.count("Exchange hashpartitioning") <= 2 and cut.count("Join") <= 1


def test_long_series_are_cut(spark, monkeypatch, data):
    monkeypatch.setattr(series, "MAX_SERIES_ROWS", 100)
    assert series.must_split(data[1], ("city",))
    plan = tsop.forward_fill(data[1], ["x"])._jdf.queryExecution().analyzed().toString()
    assert "_bucket" in plan
    monkeypatch.setattr(series, "MAX_SERIES_ROWS", 10**6)
    assert not series.must_split(data[1], ("city",))


def test_dense_series_get_shorter_buckets(data, monkeypatch):
    df = data[1]
    assert series.span_for(df, ("city",), "ts") == 30 * DAY
    monkeypatch.setattr(series, "MAX_SERIES_ROWS", 30)
    assert series.span_for(df, ("city",), "ts") == DAY
    monkeypatch.setattr(series, "MAX_SERIES_ROWS", 1)
    assert series.span_for(df, ("city",), "ts") == 3600
    assert series.span_for(df, ("city",), "ts", 77) == 77
    assert rows(tsop.forward_fill(df, ["x"])) == rows(tsop.forward_fill(df, ["x"], split=False))
    assert rows(tsop.rolling_mean(df, ["x"], by="time")) == rows(
        tsop.rolling_mean(df, ["x"], by="time", split=False))


def test_nearest_reading_prefers_the_earlier(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", base, 1.0), ("a", base + dt.timedelta(hours=2), 2.0)],
                               "city string, ts timestamp_ntz, x double")
    now = F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")
    assert joins.nearest_reading(df, now).first()["x"] == 1.0


def test_nothing_is_stored_to_measure(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), monthly=True)
    table.overwrite(to_spark(spark, gappy()))
    stages = lambda: len(list(Path(scratch_dir(spark).removeprefix("file:")).glob("stage-*")))
    before, lengths = stages(), table.lengths()
    with_lengths = tsop.forward_fill(table.read(), ["x"], split=lengths)
    plan = with_lengths._jdf.queryExecution().executedPlan().toString()
    assert stages() == before and plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert rows(with_lengths) == rows(tsop.forward_fill(table.read(), ["x"])) and stages() == before


def test_lengths_decide_on_cutting(spark, monkeypatch):
    lengths = spark.createDataFrame([("a", 6), ("a", 5), ("b", 10)], "city string, rows long")
    df = spark.createDataFrame([("a",)], "city string")
    monkeypatch.setattr(series, "MAX_SERIES_ROWS", 10)
    assert series.must_split(df, ("city",), lengths) and not series.must_split(df, ("city",))
    assert not series.must_split(df, ("city",), lengths.filter("city = 'b'"))


def test_global_rank_needs_no_task_with_all_rows(spark):
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).selectExpr("id", "if(id % 9 = 0, null, id * 7919 % 997) as v", "1 as _t")
        ranked = series.global_rank(df, [F.desc_nulls_last("v"), "id"], "place")
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "Window" not in plan
        got = ranked.orderBy("place").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    assert [r["place"] for r in got] == list(range(1, 5001))
    assert [(r["v"], r["id"]) for r in got] == sorted(((r["v"], r["id"]) for r in got), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    assert series.global_rank(df.limit(0), ["id"]).count() == 0
