"""Quality from compression: how much better a text compresses with the good dictionary than the bad.

Two zstandard dictionaries are trained on good and on bad labelled texts. The feature of a text is
the difference of its two compressed sizes, normalised by the bytes of the text and by the sizes
themselves. A logistic curve over it, fitted on labelled texts that no dictionary has seen, gives
the probability of label 1; it also knows the good size per byte and the length, because a
difference means less in a text that compresses well by itself or is short. Fitting takes a bounded sample, chosen by
a hash of the id and weighted back to the labels' true shares: per label at most ``DICTIONARY_ROWS``
texts for the dictionaries and ``CALIBRATION_ROWS`` for the curve. A dictionary learns from ``SAMPLE_CHARS``
characters of a longer text, at a place by a hash of the id; only these reach the driver. The curve is fitted on the features
of whole texts, which tasks compute, and scoring takes every whole text, too.

Defined cases: a null text is empty; all features of an empty text are 0. Ids labelled both ways,
null ids and held-out ids do not take part in fitting. With one label only, or none, the score is
the share of label 1 (0.5 without labels). Repeated rows are scored one by one.
Texts of any length are scored whole. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.calibration import fit_logistic, probability
from airloom.llm.common import bounded_batches, chunks, free_name, one_label, remainder, text_of

DICTIONARY_ROWS = 2000
CALIBRATION_ROWS = 3000
SAMPLE_CHARS = 16_000
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
FEATURES = 5


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> tuple[bytes, bool]:
    """(dictionary, whether it is raw content): too few samples to train on are used as they are."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes(), False
    except zstandard.ZstdError:
        return b"".join(samples)[-size:], True


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes, raw: bool, level: int):
    options = {"level": level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if len(dictionary) < 8:
        return zstandard.ZstdCompressor(**options)
    kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_FULLDICT
    trained = zstandard.ZstdCompressionDict(dictionary, dict_type=kind)
    trained.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=trained, **options)


@dataclass(frozen=True)
class Model:
    good: tuple[bytes, bool]
    bad: tuple[bytes, bool]
    coefficients: tuple[float, ...]
    level: int = LEVEL

    def features(self, texts: list[bytes]) -> np.ndarray:
        good, bad = (_compressor(*d, self.level) for d in (self.good, self.bad))
        n = np.array([len(t) for t in texts], float)
        g = np.array([len(good.compress(t)) for t in texts], float)
        b = np.array([len(bad.compress(t)) for t in texts], float)
        some = np.maximum(n, 1)
        difference, length = (b - g) / some, np.log1p(n)
        return np.column_stack([difference, difference * length, (b - g) / (b + g), g / some, length]) * (n > 0)[:, None]

    def score(self, texts: list[bytes]) -> np.ndarray:
        return probability(self.features(texts), np.array(self.coefficients))


def fit(
    documents: DataFrame, labels: DataFrame, held_out: Column, *, id_column: str = "doc_id", text: str = "text",
    label: str = "quality", dictionary_rows: int = DICTIONARY_ROWS, calibration_rows: int = CALIBRATION_ROWS,
) -> Model:
    """``held_out``: condition on the id column for rows that must not be learnt from."""
    known = one_label(labels, id_column, label).withColumnRenamed("id", id_column).filter(~held_out)
    shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    calibrates = F.pmod(F.xxhash64(id_column, F.lit("use")), F.lit(2)) == 1
    chosen = []
    for use, rows in ((False, dictionary_rows), (True, calibration_rows)):
        for value in (0, 1):
            part = known.filter((calibrates == use) & (F.col("label") == value))
            part = part.orderBy(F.xxhash64(id_column), id_column).limit(rows)
            chosen.append(part.withColumn("use", F.lit(use)))
    ids = chosen[0].union(chosen[1]).union(chosen[2]).union(chosen[3])
    # At most 2 * (dictionary_rows + calibration_rows) ids.
    sampled = documents.select(id_column, text_of(text).alias("text")).join(
        F.broadcast(ids), id_column)
    spare = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    piece = F.substr("text", (F.pmod(F.xxhash64(id_column, F.lit("piece")), spare) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    sample = sampled.filter("not use").groupBy(id_column, "label").agg(F.min(piece).alias("text")).orderBy(id_column).collect()
    picked = {value: [r["text"].encode() for r in sample if r["label"] == value] for value in (0, 1)}
    total = sum(shares.values())
    prior = shares.get(1, 0) / total if total else 0.5
    constant = Model((b"", True), (b"", True), (*[0.0] * FEATURES, float(np.log((prior + 1e-6) / (1 - prior + 1e-6)))))
    if not all(picked.values()):
        return constant
    model = Model(train_dictionary(picked[1]), train_dictionary(picked[0]), ())
    rows = _features(sampled.filter("use"), model, id_column).groupBy(id_column, "label").agg(
        F.min("features").alias("features")).orderBy(id_column).collect()
    x = np.array([r["features"] for r in rows]).reshape(-1, FEATURES)
    y = np.array([r["label"] for r in rows], float)
    counts = {value: int((y == value).sum()) for value in (0, 1)}
    if not all(counts.values()):
        return constant
    b = fit_logistic(x, y, np.where(y == 1, shares[1] / counts[1], shares[0] / counts[0]))
    return Model(model.good, model.bad, tuple(map(float, b)))


def _features(labelled: DataFrame, model: Model, id_column: str) -> DataFrame:
    """(id, label, features) of whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            found = model.features(batch.column("text").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), batch.column("label"), pa.array(list(found), pa.list_(pa.float64()))],
                names=[id_column, "label", "features"])

    bounded_batches(labelled.sparkSession)
    kind = labelled.schema[id_column].dataType.simpleString()
    return labelled.select(id_column, "label", "text").mapInArrow(run, f"`{id_column}` {kind}, label int, features array<double>")


def score(df: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``df`` with the column ``score`` added (``score_`` if taken)."""
    t, name = free_name(df, "_text"), free_name(df, "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, t):
            texts = batch.column(t).cast(pa.binary()).to_pylist()
            keep = [c for c in batch.schema.names if c != t]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(model.score(texts), pa.float64())], names=[*keep, name])

    bounded_batches(df.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.withColumn(t, text_of(text)).mapInArrow(run, f"{fields}, `{name}` double")


def classify(
    documents: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text: str = "text", threshold: float = 0.3,
) -> DataFrame:
    """Per document: id, held_out (crc32 of the id modulo 5 is 0), score, predicted."""
    held_out = remainder(id_column, 5) == 0
    model = fit(documents, labels, held_out, id_column=id_column, text=text)
    scored = score(documents.select(id_column, F.col(text).alias("text")), model)
    return scored.select(
        id_column, held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
