"""Regularised gradient boosting of squared error, second order, on histograms.

A tree grows level by level, and a level is one Spark job: tasks sum gradients and row counts by
(node, feature, bin) in numpy, a tree of tasks adds the sums up, and the driver, which sees nothing but them, picks
the splits. Their number is nodes x features x bins, whatever the rows. A split must gain more than ``gamma``
and leave ``min_child_weight`` rows on either side; with ``T`` shrinking a sum of gradients by ``alpha`` towards 0,

    gain = T(G_left)^2 / (n_left + lambda) + T(G_right)^2 / (n_right + lambda) - T(G)^2 / (n + lambda)

and a leaf holds ``-learning_rate T(G) / (n + lambda)``. Gradients are summed as integers, so the sums do not depend on
the order of rows or on a task that runs twice.

Rows are stored once as a byte per feature with their margin, and again every ``STORE_EVERY`` rounds; executors keep what
was stored last, in memory or on disk, and a pass adds the latest trees itself. With validation rows two ensembles grow in the same passes, one without these rows and one
with them: the first tells the number of rounds, the second is the model, so that stopping early costs no second fit.

Missing feature values fall into the lowest bin. Rows without a target are not for fitting.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.session import materialize

STORE_EVERY = 20


@dataclass(frozen=True)
class Boosting:
    """Hyperparameters."""

    rounds: int = 500
    depth: int = 4
    learning_rate: float = 0.05
    min_child_weight: float = 5
    gamma: float = 0.5
    alpha: float = 1.0
    lambda_: float = 1.0
    subsample: float = 0.8
    column_sample: float = 0.8
    bins: int = 64
    patience: int = 30
    seed: int = 42


def best_round(errors: list[float], patience: int) -> int:
    """Number of rounds up to the lowest error seen before ``patience`` rounds pass without
    a new lowest one."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


# --- trees ------------------------------------------------------------------------------

class Tree:
    """A complete binary tree in arrays: node i has the children 2i + 1 and 2i + 2; a leaf has feature -1."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.depth = depth
        self.feature = np.full(size, -1, np.int32)
        self.cut = np.zeros(size, np.int32)  # the last bin that goes left
        self.value = np.zeros(size)
        self.gain = np.zeros(size)

    def leaves(self, goes_right: Callable[[np.ndarray, np.ndarray], np.ndarray], n: int, depth: int | None = None) -> np.ndarray:
        """The node that each of ``n`` rows ends in, after ``depth`` levels at most."""
        node = np.zeros(n, np.int32)
        for _ in range(self.depth if depth is None else depth):
            splits = self.feature[node] >= 0
            if not splits.any():
                break
            node = np.where(splits, 2 * node + 1 + goes_right(node, np.maximum(self.feature[node], 0)), node)
        return node

    def of_bins(self, bins: np.ndarray, depth: int | None = None) -> np.ndarray:
        at = np.arange(len(bins))
        return self.leaves(lambda node, f: bins[at, f] > self.cut[node], len(bins), depth)


def _shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def _score(g: np.ndarray, n: np.ndarray, p: Boosting) -> np.ndarray:
    return np.divide(_shrunk(g, p.alpha) ** 2, n + p.lambda_, out=np.zeros(np.shape(g)), where=(n + p.lambda_) > 0)


def split_level(tree: Tree, nodes: list[int], g: np.ndarray, n: np.ndarray, features: np.ndarray, p: Boosting) -> list[int]:
    """Split the nodes of a level by their sums (node, feature, bin); returns the children.

    Of equal gains the lowest feature and bin win. Every child gets its value, as it may stay a leaf.
    """
    children = []
    for k, node in enumerate(nodes):
        left_g, left_n = np.cumsum(g[k], axis=1)[:, :-1], np.cumsum(n[k], axis=1)[:, :-1]
        total_g, total_n = g[k][0].sum(), n[k][0].sum()
        if node == 0:
            tree.value[0] = _leaf(total_g, total_n, p)
        right_g, right_n = total_g - left_g, total_n - left_n
        gain = _score(left_g, left_n, p) + _score(right_g, right_n, p) - _score(np.float64(total_g), np.float64(total_n), p)
        fits = (left_n >= p.min_child_weight) & (right_n >= p.min_child_weight) & (left_n > 0) & (right_n > 0)
        gain = np.where(fits, gain, -np.inf)
        if not gain.size or gain.max() <= max(p.gamma, 1e-6):
            continue
        f, cut = np.unravel_index(int(gain.argmax()), gain.shape)
        tree.feature[node], tree.cut[node], tree.gain[node] = features[f], cut, gain[f, cut]
        for child, sums in ((2 * node + 1, (left_g, left_n)), (2 * node + 2, (right_g, right_n))):
            tree.value[child] = _leaf(sums[0][f, cut], sums[1][f, cut], p)
            children.append(child)
    return children


def _leaf(g: float, n: float, p: Boosting) -> float:
    return float(-p.learning_rate * _shrunk(np.float64(g), p.alpha) / (n + p.lambda_)) if n + p.lambda_ > 0 else 0.0


# --- passes over the rows -----------------------------------------------------------------

def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) of every 64-bit id, other ones for another seed."""
    x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2**53


def _arrays(block, n_features: int, n_margins: int) -> tuple[np.ndarray, ...]:
    """Bins, targets, marks, ids and margins of a block of rows."""
    return (np.frombuffer(block["bins"], np.uint8).reshape(-1, n_features), np.frombuffer(block["y"], np.float64),
            np.frombuffer(block["held"], np.bool_), np.frombuffer(block["uid"], np.int64),
            *(np.frombuffer(block[f"margin{e}"], np.float64) for e in range(n_margins)))


def _kept(rows: DataFrame, n_features: int, n_margins: int) -> RDD:
    """The blocks as arrays, kept by the executors: a pass over them is a job without a plan."""
    return rows.rdd.map(lambda block: _arrays(block, n_features, n_margins)).persist(StorageLevel.MEMORY_AND_DISK)


def _added(a: tuple, b: tuple) -> tuple:
    return [x + y for x, y in zip(a[0], b[0])], a[1] + b[1], a[2] + b[2]


def _pass(kept: RDD, late: list[list[Tree]], grown: list[Tree], nodes: list[list[int]],
          level: int, features: np.ndarray, round_: int, scale: float, p: Boosting):
    """Sums of gradients and rows (ensemble, node, feature, bin), and the first ensemble's squared error on the validation rows."""
    bins_of = p.bins
    places = [{node: k for k, node in enumerate(ns)} for ns in nodes]

    def run(blocks: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple]:
        sums = [np.zeros((2, len(ns), len(features), bins_of), np.int64) for ns in nodes]
        error, held_rows = 0.0, 0
        for bins, y, held, uid, *margins in blocks:
            drawn = _mixed(uid, p.seed * 1_000_003 + round_) < p.subsample
            for e, margin in enumerate(margins):
                margin = margin + sum(t.value[t.of_bins(bins)] for t in late[e]) if late[e] else margin
                if e == 0 and level == 0 and held.any():
                    error += float(((margin[held] - y[held]) ** 2).sum())
                    held_rows += int(held.sum())
                if not nodes[e]:
                    continue
                at = grown[e].of_bins(bins, level)
                index = np.full(len(grown[e].feature), -1, np.int64)
                for node, k in places[e].items():
                    index[node] = k
                used = np.flatnonzero(drawn & (index[at] >= 0) & (~held if e == 0 else True))
                g = np.rint((margin[used] - y[used]) * scale)
                for k, f in enumerate(features):
                    cell = index[at[used]] * bins_of + bins[used, f]
                    shape = (len(nodes[e]), bins_of)
                    sums[e][0, :, k] += np.bincount(cell, g, shape[0] * bins_of).astype(np.int64).reshape(shape)
                    sums[e][1, :, k] += np.bincount(cell, minlength=shape[0] * bins_of).reshape(shape)
        yield sums, error, held_rows

    # Beyond a few tasks their sums are added up by tasks, so the driver gets those of a few.
    sums, error, held_rows = kept.mapPartitions(run).treeReduce(_added)
    return [(s[0].astype(np.float64) / scale, s[1].astype(np.float64)) for s in sums], error / held_rows if held_rows else math.nan


def _binned(data: DataFrame, features: str, target: str, held: Column, edges: list[np.ndarray], base: list[float]) -> DataFrame:
    """Blocks of rows, one per Arrow batch: the bytes of the arrays that ``_arrays`` reads."""
    names = ["bins", "y", "held", "uid", *(f"margin{e}" for e in range(len(base)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), np.float64).reshape(batch.num_rows, len(edges))
            x = np.where(np.isnan(x), -np.inf, x)
            bins = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1).astype(np.uint8)
            arrays = [bins, batch.column("y").to_numpy(), batch.column("held").to_numpy(zero_copy_only=False),
                      batch.column("uid").to_numpy(), *(np.full(batch.num_rows, b, np.float64) for b in base)]
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays], names=names)

    x = vector_to_array(F.col(features))
    fed = data.select(x.alias("x"), F.col(target).cast("double").alias("y"), held.alias("held"), F.xxhash64(x, F.col(target)).alias("uid"))
    return materialize(fed.mapInArrow(run, ", ".join(f"{n} binary" for n in names)))


def _advanced(rows: DataFrame, n_features: int, late: list[list[Tree]]) -> DataFrame:
    """The rows with the margins after the latest trees, stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                bins, _, _, _, *margins = _arrays(block, n_features, len(late))
                for e, m in enumerate(margins):
                    block[f"margin{e}"] = (m + sum(t.value[t.of_bins(bins)] for t in late[e])).tobytes()
                yield pa.RecordBatch.from_pylist([block], schema=batch.schema)

    return materialize(rows.mapInArrow(run, rows.schema))


def bin_edges(data: DataFrame, features: str, bins: int) -> list[np.ndarray]:
    """Greatest values of all bins but the last, for every feature: of a feature with few values all of
    these, otherwise quantiles from a bounded sketch."""
    size = len(data.select(vector_to_array(features).alias("x")).first()["x"])
    columns = [f"x{i}" for i in range(size)]
    wide = data.select(vector_to_array(features).alias("x")).select(*[F.col("x")[i].alias(c) for i, c in enumerate(columns)])
    # NaN would count as the greatest value.
    known = wide.select(*[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in columns])
    counts = known.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in columns]).first()
    few = [i for i, c in enumerate(columns) if counts[c] <= 0.9 * bins]  # fewer than ``bins`` within the count's error
    edges: list[np.ndarray] = [np.empty(0)] * size
    if few:
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(columns[i]).alias("v")) for i in few])).alias("p")
        values = known.select(pairs).select("p.*").filter("v is not null").distinct().toPandas()
        for i in few:
            edges[i] = np.sort(values.v[values.i == i].to_numpy(np.float64))[:-1][:bins - 1]
    many = [i for i in range(size) if i not in few]
    if many:
        found = known.approxQuantile([columns[i] for i in many], [i / bins for i in range(1, bins)], 1 / (8 * bins))
        for i, q in zip(many, found):
            edges[i] = np.unique(np.array(q, np.float64))
    return edges


def fit(
    data: DataFrame, p: Boosting = Boosting(), *, features: str = "features", target: str = "label",
    validation: Column | None = None, prediction: str = "prediction",
) -> BoostedModel:
    """Fit on all rows; where ``validation`` marks rows, the error on them of an ensemble fitted without
    them picks the number of rounds."""
    if p.bins > 256:
        raise ValueError("at most 256 bins")
    held = F.coalesce(validation, F.lit(False)) if validation is not None else F.lit(False)
    y, mark = F.col(target).cast("double"), F.when(~held, F.col(target).cast("double"))
    facts = data.agg(F.avg(mark).alias("fitting"), F.avg(y).alias("all"), F.count(y).alias("n"), F.min(y).alias("low"),
                     F.max(y).alias("high"), F.max(held.cast("int")).alias("held")).first()
    if not facts["n"] or facts["fitting"] is None:
        raise ValueError("no rows to fit")
    watch = bool(facts["held"])
    base = [facts["fitting"], facts["all"]] if watch else [facts["all"]]
    # The sum of all gradients stays below 2^61, a batch's below 2^53.
    spread = max(facts["high"] - facts["low"], 1e-9) * 4
    scale = 2.0 ** math.floor(min(61 - math.log2(facts["n"] * spread), 36 - math.log2(spread)))
    edges = bin_edges(data.filter(y.isNotNull()), features, p.bins)
    n_features = len(edges)
    rows = _binned(data.filter(y.isNotNull()), features, target, held, edges, base)
    kept = _kept(rows, n_features, len(base))
    trees: list[list[Tree]] = [[] for _ in base]
    late: list[list[Tree]] = [[] for _ in base]
    errors: list[float] = []
    for round_ in range(p.rounds):
        rng = np.random.default_rng([p.seed, round_])
        n_drawn = max(1, round(p.column_sample * n_features))
        drawn = np.sort(rng.choice(n_features, n_drawn, replace=False))
        grown, nodes = [Tree(p.depth) for _ in base], [[0] for _ in base]
        for level in range(p.depth):
            sums, error = _pass(kept, late, grown, nodes, level, drawn, round_, scale, p)
            if level == 0 and watch and round_:
                errors.append(error)  # of the trees before this one
            nodes = [split_level(t, ns, *s, drawn, p) for t, ns, s in zip(grown, nodes, sums)]
            if not any(nodes):
                break
        if watch and errors and len(errors) - best_round(errors, p.patience) >= p.patience:
            break
        for e, tree in enumerate(grown):
            trees[e].append(tree)
            late[e].append(tree)
        if len(late[0]) == STORE_EVERY:
            kept.unpersist()
            rows, late = _advanced(rows, n_features, late), [[] for _ in base]
            kept = _kept(rows, n_features, len(base))
    if watch and len(errors) < len(trees[0]):
        errors.append(_pass(kept, late, [Tree(0) for _ in base], [[] for _ in base], 0, np.array([0]), 0, scale, p)[1])
    kept.unpersist()
    chosen = trees[-1][:best_round(errors, p.patience)] if watch else trees[-1]
    return BoostedModel(featuresCol=features, predictionCol=prediction, ensemble=_written(chosen, edges, base[-1]),
                        settings=json.dumps(asdict(p)))


# --- the model --------------------------------------------------------------------------

def _written(trees: list[Tree], edges: list[np.ndarray], base: float) -> str:
    """Features, limits (a value above goes right), leaf values and gains of all trees as JSON."""
    def limits(t: Tree) -> list[float]:
        return [float(edges[f][c]) if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut)]

    return json.dumps({"base": base, "n_features": len(edges), "depth": trees[0].depth if trees else 0, "trees": [
        {"feature": t.feature.tolist(), "limit": limits(t), "value": t.value.tolist(), "gain": t.gain.tolist()} for t in trees]})


class BoostedModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted ensemble; a pipeline saves and loads it like any other stage."""

    ensemble = Param(Params._dummy(), "ensemble", "trees as JSON", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "hyperparameters as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", predictionCol="prediction", ensemble="{}", settings="{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def _read(self) -> dict:
        return json.loads(self.getOrDefault(self.ensemble))

    def getNumTrees(self) -> int:
        return len(self._read["trees"])

    @property
    def featureImportances(self) -> DenseVector:
        """Share of every feature in the gains of all splits."""
        read = self._read
        gains = np.zeros(read["n_features"])
        for t in read["trees"]:
            for f, gain in zip(t["feature"], t["gain"]):
                if f >= 0:
                    gains[f] += gain
        return Vectors.dense(gains / gains.sum() if gains.sum() > 0 else gains)

    def hyperparameters(self) -> dict[str, object]:
        return {**json.loads(self.getOrDefault(self.settings)), "trees": self.getNumTrees()}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        read = self._read
        trees = []
        for t in read["trees"]:
            tree = Tree(read["depth"])
            tree.feature, tree.value = np.array(t["feature"], np.int32), np.array(t["value"])
            trees.append((tree, np.array(t["limit"])))
        base = read["base"]

        @F.pandas_udf("double")
        def predicted(features: pd.Series) -> pd.Series:
            if not len(features):
                return pd.Series([], dtype="float64")
            x = np.stack(features.to_numpy()).astype(np.float64)
            x, at, out = np.where(np.isnan(x), -np.inf, x), np.arange(len(x)), np.full(len(x), base)
            for tree, limit in trees:
                out += tree.value[tree.leaves(lambda node, f: x[at, f] > limit[node], len(x))]
            return pd.Series(out)

        return dataset.withColumn(self.getPredictionCol(), predicted(vector_to_array(F.col(self.getFeaturesCol()))))
