from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from airloom.ml import boosting
from airloom.ml.boosting import Boosting

WHOLE = {"subsample": 1, "column_sample": 1}


def plain(X, y, p):
    """Boosting as the formulas say, node by node, on all distinct values; returns the predictions."""
    edges = [np.unique(c)[:-1] for c in X.T]
    shrunk = lambda g: np.sign(g) * max(abs(g) - p.alpha, 0)
    score = lambda g, n: shrunk(g) ** 2 / (n + p.lambda_)
    out = np.full(len(y), y.mean())

    def grow(rows, depth):
        g = (out - y)[rows]
        best = (max(p.gamma, 1e-6), None)
        for f, cuts in enumerate(edges if depth else []):
            for cut in cuts:
                left = X[rows, f] <= cut
                a, b = g[left], g[~left]
                if min(len(a), len(b)) < max(p.min_child_weight, 1):
                    continue
                gain = score(a.sum(), len(a)) + score(b.sum(), len(b)) - score(g.sum(), len(g))
                if gain > best[0] + 1e-7:
                    best = gain, left
        if best[1] is None:
            return [(rows, -p.learning_rate * shrunk(g.sum()) / (len(g) + p.lambda_))]
        return grow(rows[best[1]], depth - 1) + grow(rows[~best[1]], depth - 1)

    for _ in range(p.rounds):
        leaves = grow(np.arange(len(y)), p.depth)
        for rows, value in leaves:
            out[rows] += value
    return out


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(1)
    X = rng.integers(0, 12, (400, 4)).astype(float)
    y = np.round(3 * X[:, 0] + (X[:, 1] > 6) * X[:, 2] + rng.normal(0, 2, 400), 3)
    rows = [(*map(float, x), float(t), i) for i, (x, t) in enumerate(zip(X, y))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, label double, i int").repartition(3)
    return X, y, VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(df)


def predictions(model, data):
    return np.array([r["prediction"] for r in model.transform(data).orderBy("i").select("prediction").collect()])


@pytest.mark.parametrize("settings", [
    {"rounds": 3, "depth": 3}, {"rounds": 2, "depth": 2, "alpha": 0, "lambda_": 0, "gamma": 0, "min_child_weight": 1},
    {"rounds": 2, "depth": 3, "alpha": 40, "lambda_": 15, "gamma": 300}, {"rounds": 2, "depth": 3, "min_child_weight": 90}])
def test_equals_plain_boosting(sample, settings):
    X, y, data = sample
    p = Boosting(**WHOLE, learning_rate=0.3, **settings)
    assert np.allclose(predictions(boosting.fit(data, p), data), plain(X, y, p), atol=1e-6)


def test_penalties_leave_fewer_splits(sample):
    data = sample[2]
    splits = {}
    for name, more in {"none": {}, "gamma": {"gamma": 1e9}, "alpha": {"alpha": 1e9}, "weight": {"min_child_weight": 1e6}}.items():
        model = boosting.fit(data, Boosting(**WHOLE, rounds=1, depth=3, **more))
        splits[name] = sum(f >= 0 for t in json.loads(model.getOrDefault("ensemble"))["trees"] for f in t["feature"])
    assert splits == {"none": 7, "gamma": 0, "alpha": 0, "weight": 0}


def test_stored_margins_and_order_of_rows_change_no_split(sample, monkeypatch):
    def trees(data):
        found = json.loads(boosting.fit(data, p).getOrDefault("ensemble"))["trees"]
        return [(t["feature"], t["limit"]) for t in found], [t["value"] for t in found]

    data, p = sample[2], Boosting(rounds=5, depth=2)
    splits, values = trees(data)
    monkeypatch.setattr(boosting, "STORE_EVERY", 2)
    for other in (data, data.repartition(7)):
        again, near = trees(other)
        assert again == splits and np.allclose(near, values, atol=1e-9)


def test_a_level_is_one_job(spark, sample):
    """Hundreds of rounds are jobs on few rows: a plan, and a shuffle, for each of them would be most of the time."""
    def jobs(rounds):
        spark.sparkContext.setJobGroup(f"rounds-{rounds}", "")
        boosting.fit(few, Boosting(**WHOLE, rounds=rounds, depth=2, gamma=0))
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds-{rounds}"))

    few = sample[2].coalesce(1)
    try:
        assert jobs(9) - jobs(3) == 6 * 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rows_and_features_are_drawn(sample):
    ids = np.arange(100_000)
    for seed in (1, 2):
        assert abs((boosting._mixed(ids, seed) < 0.8).mean() - 0.8) < 0.01
    assert (boosting._mixed(ids, 1) != boosting._mixed(ids, 2)).all()
    model = boosting.fit(sample[2], Boosting(rounds=6, depth=3, column_sample=0.25))
    for t in json.loads(model.getOrDefault("ensemble"))["trees"]:
        assert len({f for f in t["feature"] if f >= 0}) <= 1


def test_stopping_early_keeps_the_model_of_all_rows(sample):
    X, y, data = sample
    noisy = data.withColumn("held", F.col("i") % 5 == 0).withColumn("label", F.when(F.col("held"), -F.col("label")).otherwise(F.col("label")))
    p = Boosting(**WHOLE, rounds=12, patience=2, depth=2, learning_rate=0.5)
    stopped = boosting.fit(noisy, p, validation=F.col("held"))
    assert stopped.getNumTrees() == 1  # every further round moves away from the held rows
    whole = boosting.fit(noisy, Boosting(**{**WHOLE, "rounds": 1, "depth": 2, "learning_rate": 0.5}))
    assert np.allclose(predictions(stopped, data), predictions(whole, data))
    kept = boosting.fit(data, Boosting(**WHOLE, rounds=4, depth=2), validation=F.col("i") % 5 == 0)
    assert kept.getNumTrees() == 4 and kept.hyperparameters()["alpha"] == 1.0


def test_saved_in_a_pipeline(spark, sample, tmp_path):
    data = sample[2]
    model = boosting.fit(data, Boosting(rounds=2, depth=2))
    PipelineModel(stages=[model]).write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert predictions(again, data).tolist() == predictions(model, data).tolist()
    weights = again.stages[-1].featureImportances.toArray()
    assert weights.sum() == pytest.approx(1) and weights.argmax() == 0


def test_odd_rows(spark):
    nan = float("nan")
    rows = [(nan if i % 7 == 0 else float(i), 5.0, None if i % 11 == 0 else float(i % 3), i) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, label double, i int")
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features", handleInvalid="keep").transform(df)
    model = boosting.fit(data, Boosting(rounds=2, depth=3))
    assert np.isfinite(predictions(model, data)).all() and model.featureImportances[1] == 0  # a constant is never split
    with pytest.raises(ValueError):
        boosting.fit(data.filter("label is null"), Boosting(rounds=1))


def test_quantile_bins(spark):
    df = spark.range(20_000).selectExpr("cast(id as double) as a", "cast(id % 9 as double) as b")
    wide, narrow = boosting.bin_edges(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df), "features", 32)
    assert len(wide) == 31 and np.abs(np.diff(wide) - 625).max() < 200 and narrow.tolist() == list(range(8))
