from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from helpers import same, to_spark

from airloom.operators.quantiles import approx_quantiles, exact_quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(11)
    n = 20_000
    return pd.DataFrame({
        "k": rng.choice(["x", "y", "z"], n, p=[0.8, 0.15, 0.05]),
        "smooth": rng.normal(0, 1e3, n), "heavy": rng.choice([0.0, 1.0, 1.0, 7.0], n),
        "mixed": np.where(rng.random(n) < 0.4, 5.0, rng.exponential(5, n)),
        "holes": np.where(rng.random(n) < 0.9, np.nan, rng.random(n)),
    })


def check(got, part):
    for c in ("smooth", "heavy", "mixed", "holes"):
        for a, b in zip(got[c], part[c].quantile(PROBS)):
            assert same(a, float(b)), (c, a, b)


@pytest.mark.parametrize("limit", [10**6, 500, 20, 2])
def test_whole_table(spark, values, limit):
    df = to_spark(spark, values).cache()
    check(exact_quantiles(df, ["smooth", "heavy", "mixed", "holes"], PROBS, max_interior=limit).first(), values)


@pytest.mark.parametrize("limit", [10**6, 100])
def test_per_key(spark, values, limit):
    df = to_spark(spark, values).cache()
    got = exact_quantiles(df, ["smooth", "heavy", "mixed", "holes"], PROBS, keys=("k",), max_interior=limit)
    seen = {r["k"]: r for r in got.collect()}
    assert set(seen) == {"x", "y", "z"}
    for k, r in seen.items():
        check(r, values[values.k == k])


def test_missing_single_and_empty(spark):
    df = spark.createDataFrame([("a", None), ("b", 4.0)], "k string, v double")
    got = {r["k"]: r["v"] for r in exact_quantiles(df, ["v"], [0.25, 0.5], keys=("k",)).collect()}
    assert got == {"a": None, "b": [4.0, 4.0]}
    assert exact_quantiles(df.limit(0), ["v"], [0.5]).first()["v"] is None


def test_approximate(spark, values):
    got = approx_quantiles(to_spark(spark, values), ["smooth"], [0.5]).first()["smooth"][0]
    assert abs((values.smooth < got).mean() - 0.5) < 0.01


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_describe_takes_three_scans(spark, monkeypatch, keys):
    from airloom.operators import quantiles, stats

    df = spark.range(60_000).selectExpr("id % 3 as k", "cast(id * 7919 % 60000 as double) as x", "if(id % 10 = 0, null, cast(id as double)) as y")
    scans = []
    for name in ("sketch", "count", "narrow", "whole_lists", "interior_lists"):
        made = getattr(quantiles._Search, name)
        monkeypatch.setattr(quantiles._Search, name, lambda self, *a, made=made, name=name: (scans.append(name), made(self, *a))[1])
    got = stats.describe(df, ["x", "y"], keys=keys).collect()
    assert scans == ["sketch", "count", "interior_lists"]
    pdf = df.toPandas()
    for r in got:
        part = pdf[pdf.k == r["k"]] if keys else pdf
        want = part[r["column_name"]].describe()
        assert [r[n] for n in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(list(want))


def test_profile_of_a_table_without_rows_or_numbers(spark):
    from airloom.operators import stats

    none = spark.createDataFrame([], "x double, s string")
    assert [tuple(r) for r in stats.feature_profile(none, order="none").collect()] == [("x", 0, 0, None, None, None, None, None), ("s", 0, 0, None, None, None, None, None)]
    words = spark.createDataFrame([("a",), (None,)], "s string")
    assert tuple(stats.feature_profile(words, order="none").first())[:3] == ("s", 2, 1)
    assert stats.aqi_stats(spark.createDataFrame([], "us_aqi double, ts timestamp_ntz")).first()["n"] == 0
