"""Regression trees from histograms (T3, T4): all folds of a tree, a forest or boosting in one pass a level.

A row is a few bytes: of each feature the bin between thresholds that Spark ML's rule finds, and what is left to explain.
Blocks of such rows, one set a fold, stay in memory. A pass adds up counts and sums by (node, feature, bin) of the
open nodes of every tree; they meet by tree on the cluster, and only the best split of each node comes
to the driver. Trees, depths, bins, steps and their weights are those of the Spark ML estimator given, and a tree or
boosting gets the splits that it finds; a forest has draws of its own.
"""

from __future__ import annotations

import json
import math
import pickle
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml import regression as reg
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.histograms import NO_BIN, add, best, descend, histograms, left_over, packer
from quarry.session import batches_by_rows

#: Rows of one partition of blocks.
PARTITION_ROWS = 4_000_000


def fits(est) -> bool:
    """Whether ``fit`` does all that the estimator asks for; what it lacks is left to Spark ML."""
    if not isinstance(est, (reg.DecisionTreeRegressor, reg.RandomForestRegressor, reg.GBTRegressor)):
        return False
    asked = {p.name: est.getOrDefault(p) for p in est.params if est.hasDefault(p) or est.isSet(p)}
    plain = {"minInstancesPerNode": 1, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0, "subsamplingRate": 1.0,
             "impurity": "variance", "lossType": "squared", "bootstrap": True, "leafCol": ""}
    if any(asked.get(k, v) != v for k, v in plain.items()) or any(
            asked.get(k) for k in ("weightCol", "varianceCol", "validationIndicatorCol")):
        return False
    subset = "all" if isinstance(est, reg.GBTRegressor) else "auto"
    return est.getMaxBins() < NO_BIN and asked.get("featureSubsetStrategy", subset) == subset


# ---------------------------------------------------------------- blocks of binned rows

def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """Spark ML's thresholds of a feature: halfway between neighbouring values, where there are more than ``most`` those that
    cut the rows into parts as equal as can be."""
    v, count = np.unique(values, return_counts=True)
    middle = (v[:-1] + v[1:]) / 2.0
    if len(middle) <= most:
        return middle
    stride = len(values) / (most + 1)
    target, out = stride, []
    reached = np.cumsum(count).tolist()
    for i in range(1, len(reached)):
        if abs(reached[i - 1] - target) < abs(reached[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


@dataclass
class Blocks:
    """``rdd``: blocks, of each fold the rows outside it as (bins by feature, label less ``means[fold]``)."""
    rdd: object
    edges: list[list[np.ndarray]]
    means: list[float]
    width: int


def blocks_of(frame: DataFrame, inputs: list[str], label: str, fold: str, folds: int, max_bins: int, seed: int) -> Blocks:
    """Thresholds come from as many rows as Spark ML takes for them, max_bins squared or 10,000 of a fold's
    complement: at most half as many again come to the driver."""
    cols = [F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(inputs)]
    rows = frame.select(F.col(fold).cast("int").alias("f"), F.col(label).cast("double").alias("y"), *cols)
    parts = {r["f"]: (r["n"], r["s"]) for r in rows.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")).collect()}
    total = sum(n for n, _ in parts.values())
    if not all(math.isfinite(s) for _, s in parts.values()):
        raise ValueError("labels must not be NaN or infinite")
    rest = [[(n, s) for f, (n, s) in parts.items() if folds == 1 or f != j] for j in range(folds)]
    sizes = [sum(n for n, _ in part) for part in rest]
    if not all(sizes):
        raise ValueError("a fold has all rows")
    means = [sum(s for _, s in part) / n for part, n in zip(rest, sizes, strict=True)]
    wanted = max(max_bins * max_bins, 10_000)
    share = max(wanted / n for n in sizes)
    seen = (rows.drop("y") if share >= 1 else rows.drop("y").sample(False, share, seed)).toArrow()
    at = seen["f"].to_numpy()
    values = [seen[f"x{i}"].to_numpy() for i in range(len(inputs))]
    edges = [[thresholds(v[at != j] if folds > 1 else v, min(max_bins, n) - 1) for v in values] for j, n in enumerate(sizes)]
    width = 1 + max((len(e) for part in edges for e in part), default=0)
    cores = frame.sparkSession.sparkContext.defaultParallelism
    wide = cores * -(-total // (cores * PARTITION_ROWS))
    packed = rows.coalesce(wide).mapInArrow(packer(edges, means, folds, len(inputs)), "block binary")
    with batches_by_rows(frame.sparkSession):
        rdd = packed.rdd.map(lambda r: pickle.loads(r[0])).persist(StorageLevel.MEMORY_AND_DISK)
        rdd.count()
    return Blocks(rdd, edges, means, width)


# ---------------------------------------------------------------- growing

@dataclass
class Tree:
    """Node i: rows with feature[i] above bin[i] go to left[i] + 1, others to left[i]; a leaf leads to itself."""
    feature: list[int] = field(default_factory=lambda: [0])
    bin: list[int] = field(default_factory=lambda: [NO_BIN])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def arrays(self):
        return np.array(self.feature), np.array(self.bin, np.uint16), np.array(self.left)

    def split(self, node: int, feature: int, at: int, values) -> list[int]:
        children = [len(self.left), len(self.left) + 1]
        self.feature[node], self.bin[node], self.left[node] = feature, at, children[0]
        for child, value in zip(children, values, strict=True):
            self.feature.append(0)
            self.bin.append(NO_BIN)
            self.left.append(child)
            self.value.append(value)
        return children


def grow(rdd, keys, width: int, n_features: int, depth: int, draws: tuple[int, int] | None = None, per_node: int | None = None,
         seed: int = 0) -> dict:
    """One tree a key (fold, number), all a level at a time. ``draws`` (seed, trees) bootstraps the rows, ``per_node`` features
    are tried at a node."""
    trees = {key: Tree() for key in keys}
    level_nodes = {key: [0] for key in keys}
    for level in range(depth):
        if not level_nodes:
            break
        open_nodes = {}
        for key, nodes in level_nodes.items():
            local = np.full(len(trees[key].left), -1)
            local[nodes] = np.arange(len(nodes))
            chosen = None
            if per_node is not None and per_node < n_features:
                rng = np.random.default_rng([seed, *key, level])
                chosen = np.argsort(rng.random((len(nodes), n_features)), axis=1)[:, :per_node]
            open_nodes[key] = (trees[key].arrays(), local, len(nodes), chosen)
        found = rdd.mapPartitionsWithIndex(histograms(open_nodes, level, width, draws)) \
            .reduceByKey(add, min(len(keys), rdd.getNumPartitions())).mapValues(lambda t: best(t, width)).collect()
        following = {}
        for key, (slot, at, gain, n, s, n_left, s_left) in found:
            tree, nodes, chosen = trees[key], level_nodes[key], open_nodes[key][3]
            if level == 0 and n[0] > 0:
                tree.value[0] = float(s[0] / n[0])
            for i, node in enumerate(nodes):
                if np.isfinite(gain[i]):
                    f = int(slot[i] if chosen is None else chosen[i, slot[i]])
                    values = [float(s_left[i] / n_left[i]), float((s[i] - s_left[i]) / (n[i] - n_left[i]))]
                    following.setdefault(key, []).extend(tree.split(node, f, int(at[i]), values))
        level_nodes = following
    return trees


def fit(est, blocks: Blocks, inputs: list[str], folds: int) -> list[TreesModel]:
    """The models of all folds' complements, with the parameters of a Spark ML regressor (``fits``)."""
    depth, seed, shape = est.getMaxDepth(), est.getSeed(), (blocks.width, len(inputs))
    found: list[list[tuple[Tree, float]]] = [[] for _ in range(folds)]
    if isinstance(est, reg.GBTRegressor):
        state, older = blocks.rdd, []
        for step in range(est.getMaxIter()):
            trees = grow(state, [(j, 0) for j in range(folds)], *shape, depth)
            for rdd in older:  # the pass has filled the newer one
                rdd.unpersist()
            older = [] if state is blocks.rdd else [state]
            # the first tree counts in full; the others explain the loss's gradient, twice what is left
            weight = 1.0 if step == 0 else 2.0 * est.getStepSize()
            for (j, _), tree in trees.items():
                found[j].append((tree, weight))
            if step + 1 < est.getMaxIter():
                told = {j: (tree.arrays(), np.array(tree.value) * weight) for (j, _), tree in trees.items()}
                state = state.map(left_over(told, depth)).persist(StorageLevel.MEMORY_AND_DISK)
                if (step + 1) % est.getCheckpointInterval() == 0:
                    state.checkpoint()
        for rdd in older:
            rdd.unpersist()
    else:
        n_trees = est.getNumTrees() if isinstance(est, reg.RandomForestRegressor) else 1
        single = n_trees == 1 and isinstance(est, reg.DecisionTreeRegressor)
        trees = grow(blocks.rdd, [(j, k) for j in range(folds) for k in range(n_trees)], *shape, depth,
                     None if single else (seed & (2 ** 63 - 1), n_trees), -(-len(inputs) // 3) if n_trees > 1 else None,
                     seed & (2 ** 63 - 1))
        for (j, _), tree in trees.items():
            found[j].append((tree, 1.0 / n_trees))
    return [TreesModel.of(part, blocks.edges[j], blocks.means[j], inputs, est.getPredictionCol())
            for j, part in enumerate(found)]


# ---------------------------------------------------------------- model

class TreesModel(Model, HasInputCols, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """A constant plus a weighted sum of trees of double columns."""

    trees = Param(Params._dummy(), "trees", "constant and trees as JSON", typeConverter=TypeConverters.toString)

    @classmethod
    def of(cls, parts, edges, constant: float, inputs, prediction: str) -> TreesModel:
        trees = []
        for tree, weight in parts:
            leaf = [left == i for i, left in enumerate(tree.left)]
            trees.append({"feature": tree.feature, "left": tree.left,
                          "threshold": [None if end else float(edges[f][b]) for f, b, end in zip(tree.feature, tree.bin, leaf, strict=True)],
                          "value": [v * weight if end else 0.0 for v, end in zip(tree.value, leaf, strict=True)]})
        model = cls()
        model._set(inputCols=list(inputs), predictionCol=prediction, trees=json.dumps({"constant": constant, "trees": trees}))
        return model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        about = json.loads(self.getOrDefault(self.trees))
        constant = about["constant"]
        tables = [(np.array(t["feature"]), np.array([math.inf if c is None else c for c in t["threshold"]]), np.array(t["left"]),
                   np.array(t["value"]), _depth(t["left"])) for t in about["trees"]]

        def score(*columns: pd.Series) -> pd.Series:
            n = len(columns[0])
            flat = np.concatenate([c.to_numpy(np.float64) for c in columns])
            rows, total = np.arange(n), np.full(n, constant)
            for feature, cut, left, value, steps in tables:
                total += value.take(descend(flat, rows, n, (feature, cut, left), steps))
            return pd.Series(total)

        return dataset.withColumn(self.getPredictionCol(), F.pandas_udf(score, "double")(
            *[F.col(f"`{c}`") for c in self.getInputCols()]))


def _depth(left: list[int]) -> int:
    depth = [0] * len(left)
    for i, child in enumerate(left):
        if child != i:
            depth[child] = depth[child + 1] = depth[i] + 1
    return max(depth)
