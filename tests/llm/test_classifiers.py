"""Quality and toxicity: held-out accuracy, what is learnt from, and edges."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from airloom.llm import calibration, quality_classifier, toxicity
from airloom.llm.queries import QUERIES
from tests.llm.frames import ids, odd_documents, odd_labels

FOLDER = "/root/testdata/sf0.1"
CASES = {"op1_quality_classifier": ("quality", 5, 0, 0.3, quality_classifier), "op4_toxicity": ("toxic", 3, 1, 0.7, toxicity)}


def area(score, y):
    """Probability that a row of label 1 scores higher than one of label 0."""
    a, b = (np.array([s for s, v in zip(score, y) if v == k]) for k in (1, 0))
    return np.mean([(np.sum(x > b) + 0.5 * np.sum(x == b)) / len(b) for x in a])


@pytest.mark.parametrize("name,least", [("op1_quality_classifier", 0.97), ("op4_toxicity", 0.92)])
def test_held_out_accuracy(spark, name, least):
    label, n, left, threshold, _ = CASES[name]
    known = dict(duckdb.connect().execute(f"SELECT doc_id, {label} FROM '{FOLDER}/labels.parquet'").fetchall())
    rows = QUERIES[name](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % n == left) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= threshold) for r in rows)
    held = [(r["score"], known[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in known]
    assert area(*zip(*held)) >= least
    right = np.mean([(s >= threshold) == y for s, y in held])
    assert right >= 0.94


@pytest.mark.parametrize("name", CASES)
def test_held_out_labels_are_not_learnt(spark, name):
    """Turning the held-out labels round changes no score."""
    label, n, left, _, module = CASES[name]
    docs = spark.read.parquet(f"{FOLDER[:-3]}0.01/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER[:-3]}0.01/labels.parquet").collect()
    turned = [(r["doc_id"], 1 - r[label] if zlib.crc32(str(r["doc_id"]).encode()) % n == left else r[label]) for r in labels]
    one = module.classify(docs, spark.createDataFrame([(r["doc_id"], r[label]) for r in labels], f"doc_id long, {label} int"))
    two = module.classify(docs, spark.createDataFrame(turned, f"doc_id long, {label} int"))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


@pytest.mark.parametrize("name", CASES)
def test_edges(spark, name):
    module = CASES[name][-1]
    df, labels = odd_documents(spark), odd_labels(spark)
    rows = module.classify(df, labels).collect()
    assert ids(rows) == ids(df.collect()) and all(0 <= r["score"] <= 1 for r in rows)
    alone = module.classify(df, labels.limit(0)).collect()
    assert all(abs(r["score"] - 0.5) < 1e-6 for r in alone)
    assert module.classify(df.limit(0), labels).count() == 0


def test_logistic_curve_is_calibrated():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20_000, 2))
    p = 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))
    y = (rng.random(len(p)) < p).astype(float)
    b = calibration.fit_logistic(x, y, np.ones(len(y)))
    assert np.allclose(b, [2, -1, 0.5], atol=0.15)
    assert np.isfinite(calibration.fit_logistic(x, np.ones(len(y)), np.ones(len(y)))).all()


def test_word_counts_equal_plain_counts(spark):
    rows = [("Stupid clown, stupid!", 1), ("a fine day", 0), ("", 0), ("the clown", 1), ("é Ñandú 12 x", 0)] * 3
    got = toxicity.count_words(spark.createDataFrame(rows, "text string, label int")).collect()
    want = {}
    for t, y in rows:
        for s in toxicity.word_slots(t).tolist():
            want.setdefault(s, [0, 0])[y] += 1
    assert {r["slot"]: [r["n0"], r["n1"]] for r in got} == want


def test_every_word_of_a_growing_vocabulary_counts(spark, monkeypatch):
    """Rare words, and many words that are a little likelier in toxic texts, raise a score, whatever is joined or looked up."""
    rng = np.random.default_rng(4)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    names = sorted({"".join(rng.choice(letters, 9)) for _ in range(30_000)})
    plain, mild, rare, filler = names[:200], names[200:400], names[400:440], iter(names[440:])
    rows = []
    for i in range(600):
        toxic = int(i % 4 == 0)
        words = [*rng.choice(plain, 30), *rng.choice(mild, 10 if toxic else 2), *(next(filler) for _ in range(20))]
        words += list(rng.choice(rare, 2)) if toxic else []
        rows.append((i, " ".join(words), toxic))
    probes = {10_001: plain[:30], 10_002: plain[:28] + rare[:2], 10_003: mild[:30]}
    docs = spark.createDataFrame([r[:2] for r in rows] + [(i, " ".join(w)) for i, w in probes.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    counts = {r["slot"]: r for r in toxicity.count_words(docs.join(labels, "doc_id").select("text", F.col("toxic").alias("label"))).collect()}
    pairs = {(a, b) for _, t, _ in rows for a, b in zip(["", *t.split()], t.split())}
    assert len(counts) == len({b for _, b in pairs}) > 12_000
    assert sum(r["contexts"] for r in counts.values()) == len(pairs)
    got = {}
    for frequent in (1, 200, 1 << 18):
        monkeypatch.setattr(toxicity, "FREQUENT", frequent)
        got[frequent] = {r["doc_id"]: r["score"] for r in toxicity.classify(docs, labels).collect()}
    assert got[1] == got[200] == got[1 << 18]
    assert got[1][10_002] > got[1][10_001] + 0.1 and got[1][10_003] > got[1][10_001] + 0.1


def test_long_labelled_texts_are_learnt(spark):
    rng = np.random.default_rng(2)
    words = {1: ["river", "stone", "quiet", "morning", "letter", "garden"], 0: ["BUY", "now!!", "$$$", "click", "FREE", "win"]}
    rows = [(i, " ".join(rng.choice(words[i % 2], 4000)), i % 2) for i in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    assert min(len(t) for _, t, _ in rows) > quality_classifier.SAMPLE_CHARS
    got = {r["doc_id"]: r["score"] for r in quality_classifier.classify(docs, labels).collect()}
    assert min(got[i] for i in range(1, 120, 2)) > 0.9 and max(got[i] for i in range(0, 120, 2)) < 0.1
