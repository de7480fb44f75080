"""Toxicity by two class-conditional Kneser-Ney models with shared backoff.

The class is the history of a word: with counts c over the labelled texts,

    P(word | class) = max(c(class, word) - D, 0) / c(class) + D * types(class) / c(class) * P(word),

where P(word), shared by both classes, counts in how many contexts (distinct words before it) a word
occurs instead of how often. D is estimated from words seen once and twice. One occurrence more, dealt
to the classes by their words, takes the estimates of rare expressions nearer to each other. No word is
left out: r is the log ratio of the two estimates, and a word of no labelled text has r = 0. The
statistic of a text is the mean of r^3 over its words, as the drift of ordinary words otherwise hides
the few that tell; a logistic curve, fitted on labelled texts that are not counted, turns it into the
probability of label 1.

Words are 64-bit hashes, and counts, contexts and ratios are Spark tables that grow with the
vocabulary. Ratios of words with at least one in ``FREQUENT`` of the counted words (so ``FREQUENT`` words
at most) go to all tasks; all others are joined. Ratios are summed as whole ``STEPS``, in any order alike.

Defined cases: a null text is empty; a text without words has the statistic 0. Ids that are null,
held out or labelled both ways are not learnt from. With one label only, or none, the score is the
share of label 1 (0.5 without labels). Repeated rows count and are scored one by one.
Texts of any length are scored whole. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.calibration import fit_logistic
from airloom.llm.common import bounded_batches, chunks, one_label, remainder, text_of
from airloom.session import materialize

FREQUENT = 1 << 18
STEPS = 1_000_000
#: Labels up to this number are broadcast (16 bytes each), more are joined by a shuffle.
BROADCAST_LABELS = 2_000_000
#: Of the labelled texts this share (one in ...) is kept for the curve.
CALIBRATION_SHARE = 5
#: Bins of the root of the statistic that the curve is fitted on, for every unit of it.
BINS = 400

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


class _Hashes(dict):
    """Hashes of the words of a process, forgotten when there are many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        self[word] = n = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little", signed=True)
        return n


_HASHES = _Hashes()
_START = 0


def word_slots(text: str) -> np.ndarray:
    """Hashes of the lower-cased words; ASCII characters that are no letters separate words."""
    raw = np.frombuffer(text.lower().encode(), np.uint8)
    words = _LETTERS[raw].tobytes().split()
    return np.fromiter(map(_HASHES.__getitem__, words), np.int64, len(words))


@dataclass(frozen=True)
class Model:
    ratios: DataFrame | None  # stored (slot, steps, n) of all words of the labelled texts; None: all are 0
    least: float  # words with so many occurrences are looked up, the others joined
    coefficients: np.ndarray


def _curve_input(x: np.ndarray) -> np.ndarray:
    """The statistic and its root (ratios of single words weigh less in long texts)."""
    return np.column_stack([x, np.sign(x) * np.sqrt(np.abs(x))])


def _labelled(documents: DataFrame, labels: DataFrame, held_out: Column, id_column: str, text: str, label: str) -> DataFrame:
    known = one_label(labels, id_column, label).withColumnRenamed("id", id_column).filter(~held_out)
    known = materialize(known)
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    return documents.select(id_column, text_of(text).alias("text")).join(known, id_column)


def count_words(labelled: DataFrame) -> DataFrame:
    """(slot, n0, n1, contexts): counts by label and distinct words before, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            slots = [word_slots(t) for t in batch.column("text").to_pylist()]
            before = [np.append(_START, s[:-1]) for s in slots if len(s)]
            label = np.repeat(batch.column("label").to_numpy(), [len(s) for s in slots])
            if before:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(slots)), pa.array(np.concatenate(before)), pa.array(label.astype(np.int32))],
                    names=["slot", "before", "label"])

    bounded_batches(labelled.sparkSession)
    rows = labelled.select("text", "label").mapInArrow(run, "slot bigint, before bigint, label int")
    pairs = rows.groupBy("slot", "before").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("n1"))
    return pairs.groupBy("slot").agg(
        F.sum(F.col("n") - F.col("n1")).alias("n0"), F.sum("n1").alias("n1"), F.count(F.lit(1)).alias("contexts"))


def log_ratios(counts: DataFrame) -> tuple[DataFrame | None, int]:
    """(slot, ratio, n) of every word, and the number of words counted. ``counts`` is stored."""
    t = counts.agg(
        F.sum("contexts").alias("contexts"),
        *(F.sum(f"n{c}").alias(f"n{c}") for c in (0, 1)),
        *(F.count(F.when(F.col(f"n{c}") > 0, 1)).alias(f"types{c}") for c in (0, 1)),
        *(F.count(F.when(F.col(f"n{c}") == k, 1)).alias(f"ones{c}{k}") for c in (0, 1) for k in (1, 2)),
    ).first()
    if not t["n0"] or not t["n1"]:
        return None, 0
    total = t["n0"] + t["n1"]

    def estimate(c: int) -> Column:
        """Relative to the share of the class, so that a word without counts has the same in both."""
        ones, twos = t[f"ones{c}1"], t[f"ones{c}2"]
        d = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5
        own = F.greatest(F.col(f"n{c}") - d, F.lit(0.0))
        share = t[f"n{c}"] / total
        return (own + d * t[f"types{c}"] * F.col("contexts") / t["contexts"] + share) / share

    return counts.select("slot", F.log(estimate(1) / estimate(0)).alias("ratio"), (F.col("n0") + F.col("n1")).alias("n")), total


def with_statistic(df: DataFrame, model: Model, text: str, into: str) -> DataFrame:
    """``df`` with the statistic added, without its text."""
    kept = [c for c in df.columns if c != text]
    if model.ratios is None:
        return df.select(*kept, F.lit(0.0).alias(into))
    frequent = model.ratios.filter(F.col("n") >= model.least).select("slot", "steps").orderBy("slot").toArrow()  # FREQUENT rows at most
    shared = df.sparkSession.sparkContext.broadcast(
        (frequent.column("slot").to_numpy(), frequent.column("steps").to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, steps = shared.value
        for batch in chunks(batches, "_text"):
            words, known, rare, times = [], [], [], []
            for t in batch.column("_text").to_pylist():
                s = word_slots(t)
                words.append(len(s))
                s, n = np.unique(s, return_counts=True)
                at = np.minimum(np.searchsorted(slots, s), max(len(slots) - 1, 0))
                hit = slots[at] == s if len(slots) else np.zeros(len(s), bool)
                known.append(int((steps[at[hit]] * n[hit]).sum()) if len(slots) else 0)
                rare.append(s[~hit])
                times.append(n[~hit])
            ends = pa.array(np.append(0, np.cumsum([len(r) for r in rare])).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(words, pa.int64()), pa.array(known, pa.int64()),
                 *(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).astype(np.int64))) for x in (rare, times))],
                names=[*names, "_words", "_known", "_rare", "_times"])

    bounded_batches(df.sparkSession)
    rows = df.select(*(F.col(c).alias(f"_c{i}") for i, c in enumerate(kept)), text_of(text).alias("_text"))
    rows = rows.withColumn("_uid", F.monotonically_increasing_id())
    names = [c for c in rows.columns if c != "_text"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    rows = materialize(rows.mapInArrow(
        run, f"{fields}, _words bigint, _known bigint, _rare array<bigint>, _times array<bigint>"))
    each = rows.select("_uid", F.explode(F.arrays_zip("_rare", "_times")).alias("word"))
    joined = (
        each.select("_uid", F.col("word._rare").alias("slot"), F.col("word._times").alias("times"))
        .join(model.ratios.filter(F.col("n") < model.least).select("slot", "steps"), "slot")
        .groupBy("_uid").agg(F.sum(F.col("steps") * F.col("times")).alias("_joined"))
    )
    found = rows.drop("_rare", "_times").join(joined, "_uid", "left")
    total = F.col("_known") + F.coalesce("_joined", F.lit(0))
    mean = F.when(F.col("_words") > 0, total / STEPS / F.col("_words")).otherwise(0.0)
    return found.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(kept)), mean.alias(into))


def fit(
    documents: DataFrame, labels: DataFrame, held_out: Column, *, id_column: str = "doc_id", text: str = "text",
    label: str = "toxic",
) -> Model:
    """``held_out``: condition on the id column for rows that must not be learnt from."""
    rows = _labelled(documents, labels, held_out, id_column, text, label)
    kept = F.pmod(F.xxhash64(id_column, F.lit("curve")), F.lit(CALIBRATION_SHARE)) == 0
    ratios, total = log_ratios(materialize(count_words(rows.filter(~kept))))
    if ratios is not None:
        cubes = F.round(F.pow("ratio", F.lit(3.0)) * STEPS).cast("long")
        ratios = materialize(ratios.select("slot", cubes.alias("steps"), "n"))
    model = Model(ratios, total / FREQUENT, np.zeros(3))
    scored = with_statistic(rows.filter(kept).select("label", "text"), model, "text", "x")
    root = F.signum("x") * F.sqrt(F.abs("x"))
    bins = scored.groupBy(F.round(root * BINS).cast("long").alias("bin"), "label").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("x") * STEPS).cast("long")).alias("x")).collect()
    bins.sort(key=lambda r: (r["bin"], r["label"]))
    # The ratios have bounds, and so has the number of bins.
    if len({r["label"] for r in bins}) < 2:
        n = sum(r["n"] for r in bins)
        share = (sum(r["n"] for r in bins if r["label"] == 1) / n) if n else 0.5
        return Model(None, 0, np.array([0, 0, np.log((share + 1e-6) / (1 - share + 1e-6))]))
    b = fit_logistic(
        _curve_input(np.array([r["x"] / r["n"] / STEPS for r in bins])), np.array([float(r["label"]) for r in bins]),
        np.array([float(r["n"]) for r in bins]))
    return Model(model.ratios, model.least, b)


def classify(
    documents: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text: str = "text", threshold: float = 0.7,
) -> DataFrame:
    """Per document: id, held_out (crc32 of the id modulo 3 is 1), score, predicted."""
    held_out = remainder(id_column, 3) == 1
    model = fit(documents, labels, held_out, id_column=id_column, text=text)
    scored = with_statistic(documents.select(id_column, F.col(text).alias("text")), model, "text", "x")
    x = F.col("x")
    first, second, constant = map(float, model.coefficients)
    z = first * x + second * F.signum(x) * F.sqrt(F.abs(x)) + constant
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    scored = scored.withColumn("score", score)
    return scored.select(
        id_column, held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
