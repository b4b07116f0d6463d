"""Forests and boosted trees of Spark ML, grown on counted cells instead of rows.

A tree of Spark ML sees of a row only the bins of its features, its label and its weight. Rows
that agree in these are one cell; the aggregate that counts them is the only pass over the rows.
Cells fill up: their number is bounded by the bins, not by the rows. A bootstrap gives each row
a Poisson(1) count, so a cell of n rows gets a Poisson(n) count; a subsample without
replacement keeps Binomial(n, rate) rows of it. The trees of a forest are dealt over tasks.
The result is a model of Spark ML.
"""

from __future__ import annotations

import json
import math
import sys
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import scratch_path, stage

#: Up to so many rows Spark ML fits the rows themselves, so that models of small tables stay what they were.
ROWS = 20_000
#: Bins (cells times features) that a task may hold; with more, Spark ML fits the rows.
MOST_BINS = 8_000_000
#: Gains below this are rounding.
LEAST_GAIN = 1e-13
# Tasks get the functions themselves: a worker need not find this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODES = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, "
    "gain double, leftChild int, rightChild int, "
    "split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)


def supports(estimator) -> bool:
    """Whether trees of ``estimator`` are grown by the rules of this module."""
    if not isinstance(estimator, RandomForestClassifier | GBTClassifier):
        return False
    plain = estimator.getMinInstancesPerNode() == 1 and estimator.getMinInfoGain() == 0 and estimator.getMinWeightFractionPerNode() == 0
    if isinstance(estimator, GBTClassifier):
        return plain and estimator.getFeatureSubsetStrategy() == "all" and not estimator.isSet("validationIndicatorCol")
    whole = estimator.getBootstrap() or estimator.getSubsamplingRate() == 1.0
    usual = estimator.getImpurity() == "gini" and estimator.getFeatureSubsetStrategy() in ("auto", "sqrt", "onethird", "all")
    return plain and whole and usual and estimator.getNumTrees() > 1


def find_thresholds(estimator, vectors: DataFrame) -> list[list[float]] | None:
    """The thresholds between bins per feature, found by Spark ML's own function; a 0/1 feature has 0.5.

    None where the label is not 0/1 or a feature has more than two categories.
    """
    spark = vectors.sparkSession
    jvm = spark._jvm
    groups = vectors.schema[estimator.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    if "nominal" in groups or vectors.where(~F.col(estimator.getLabelCol()).isin(0, 1)).limit(1).count():
        return None
    binary = [a["idx"] for a in groups.get("binary", [])]
    estimator._transfer_params_to_java()
    instances = getattr(getattr(jvm.org.apache.spark.ml.util, "DatasetUtils$"), "MODULE$").extractInstances(estimator._java_obj, vectors._jdf, jvm.scala.Option.empty())
    strategy = jvm.org.apache.spark.mllib.tree.configuration.Strategy.defaultStrategy("Classification")
    strategy.setMaxBins(estimator.getMaxBins())
    strategy.setCategoricalFeaturesInfo({i: 2 for i in binary})
    trees = jvm.org.apache.spark.ml.tree.impl
    metadata = getattr(getattr(trees, "DecisionTreeMetadata$"), "MODULE$").buildMetadata(instances, strategy)
    found = getattr(getattr(trees, "RandomForest$"), "MODULE$").findSplits(instances, metadata, estimator.getSeed())
    return [[0.5] if i in binary else [s.threshold() for s in splits] for i, splits in enumerate(found)]


def count_cells(estimator, vectors: DataFrame, thresholds: Sequence[Sequence[float]]) -> DataFrame:
    """(bins, y, w, n): how many rows share the bin of every feature, the label and the weight."""
    weight = F.col(estimator.getWeightCol()).cast("double") if estimator.isSet("weightCol") else F.lit(1.0)
    x = vectors.select(
        vector_to_array(estimator.getFeaturesCol()).alias("x"), F.col(estimator.getLabelCol()).cast("int").alias("y"), weight.alias("w")
    )
    bins = [reduce(add, [(F.col("x")[i] > t).cast("short") for t in ts], F.lit(0).cast("short")).cast("short") for i, ts in enumerate(thresholds)]
    binned = x.select(F.array(*bins).alias("bins"), "y", "w")
    return binned.groupBy("bins", "y", "w").agg(F.count("*").alias("n"))


def grow(
    bins: np.ndarray,
    sizes: Sequence[int],
    counts: np.ndarray,
    weights: np.ndarray,
    target: np.ndarray,
    depth: int,
    choose: Callable[[int], np.ndarray] | None = None,
) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """One tree by least squares: its nodes by level, and the last node of each cell.

    ``bins`` is features x cells. For a 0/1 target the least squares split is that of the Gini impurity, whose gain is twice
    as large. ``choose`` gives a mask of the features that each of so many nodes may use.
    """
    cw, cs = counts * weights, counts * weights * target
    at = np.zeros(len(counts), dtype=np.int64)
    levels, first, live = [], 0, np.arange(len(counts))
    here = np.zeros(len(counts), dtype=np.int64)  # node of each live cell, counted within the level
    k = 1
    for level in range(depth + 1):
        c, w, s = (np.bincount(here, x[live], k) for x in (counts, cw, cs))
        squares = np.bincount(here, cs[live] * target[live], k)
        best, feature, cut = np.full(k, LEAST_GAIN), np.full(k, -1), np.zeros(k, dtype=np.int64)
        if level < depth:
            allowed = choose(k) if choose else None
            for f, size in enumerate(sizes):
                if size < 2:
                    continue
                rows, key = live, here
                if allowed is not None:
                    kept = allowed[here, f]
                    rows, key = live[kept], here[kept]
                key = key * size + bins[f, rows]
                lc, lw, ls = (np.cumsum(np.bincount(key, x[rows], k * size).reshape(k, size), 1)[:, :-1] for x in (counts, cw, cs))
                rc, rw, rs = c[:, None] - lc, w[:, None] - lw, s[:, None] - ls
                valid = (lc > 0) & (rc > 0) & (lw > 0) & (rw > 0)
                if allowed is not None:
                    valid &= allowed[:, f, None]
                if not valid.any():
                    continue
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(valid, (ls * ls / lw + rs * rs / rw - (s * s / w)[:, None]) / w[:, None], -1.0)
                at_best = gain.argmax(1)
                top = gain[np.arange(k), at_best]
                better = top > best
                best[better], feature[better], cut[better] = top[better], f, at_best[better]
        split = feature >= 0
        order = np.cumsum(split) - 1
        left = np.where(split, first + k + 2 * order, -1)
        levels.append({"c": c, "w": w, "s": s, "squares": squares, "gain": best, "feature": feature, "cut": cut, "left": left})
        at[live] = first + here
        first += k
        k = 2 * int(split.sum())
        if not k:
            break
        going = split[here]
        live, here = live[going], here[going]
        here = 2 * order[here] + (bins[feature[here], live] > cut[here])
    return {name: np.concatenate([x[name] for x in levels]) for name in levels[0]}, at


def _merge_alike(tree: dict[str, np.ndarray], prediction: np.ndarray) -> np.ndarray:
    """Nodes that stay when two leaves of one prediction become their parent, from the bottom up."""
    left, kept = tree["left"], np.ones(len(prediction), dtype=bool)
    for node in range(len(prediction) - 1, -1, -1):  # children come after their parent
        a = left[node]
        if a >= 0 and left[a] < 0 and left[a + 1] < 0 and prediction[a] == prediction[a + 1]:
            left[node] = -1
            kept[a : a + 2] = False
    return kept


def _node_rows(number: int, tree: dict[str, np.ndarray], thresholds: Sequence[Sequence[float]], gini: bool, binary: Sequence[bool]) -> list[tuple]:
    """The nodes of a tree as Spark ML stores them."""
    c, w, s, squares = (tree[x] for x in ("c", "w", "s", "squares"))
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = np.where(w > 0, s / w, 0.0)
        impurity = 2 * mean * (1 - mean) if gini else np.where(w > 0, squares / w, 0.0) - mean * mean
    prediction = (s > w - s).astype(float) if gini else mean
    kept = _merge_alike(tree, prediction) if gini else np.ones(len(c), dtype=bool)
    ids, left = np.cumsum(kept) - 1, tree["left"]
    rows = []
    for i in np.flatnonzero(kept):
        stats = [float(w[i] - s[i]), float(s[i])] if gini else [float(w[i]), float(s[i]), float(squares[i])]
        if left[i] < 0:
            gain, children, split = -1.0, (-1, -1), (-1, [], -1)
        else:
            f, gain = int(tree["feature"][i]), float(tree["gain"][i]) * (2 if gini else 1)
            children = (int(ids[left[i]]), int(ids[left[i] + 1]))
            split = (f, [0.0], 2) if binary[f] else (f, [float(thresholds[f][tree["cut"][i]])], -1)
        rows.append((number, (int(ids[i]), float(prediction[i]), float(impurity[i]), stats, int(c[i]), gain, *children, split)))
    return rows


def _forest(found: tuple, numbers: Sequence[int], settings: dict) -> Iterator[list[tuple]]:
    """The trees with these numbers; each draws its own counts and features by its number."""
    bins, y, w, n = found
    features, chosen = len(settings["thresholds"]), settings["chosen"]
    for number in numbers:
        rng = np.random.default_rng([settings["seed"], number])
        counts = rng.poisson(n * settings["rate"]).astype(float) if settings["bootstrap"] else n.astype(float)
        drawn = counts > 0

        def choose(k: int) -> np.ndarray:
            mask = np.zeros((k, features), dtype=bool)
            np.put_along_axis(mask, rng.random((k, features)).argsort(1)[:, :chosen], True, 1)
            return mask

        tree, _ = grow(bins[:, drawn], settings["sizes"], counts[drawn], w[drawn], y[drawn], settings["depth"], choose if chosen < features else None)
        yield _node_rows(number, tree, settings["thresholds"], True, settings["binary"])


def _boosted(found: tuple, numbers: Sequence[int], settings: dict) -> Iterator[list[tuple]]:
    """Trees one after another, each on the gradient of the logistic loss that those before it leave."""
    bins, y, w, n = found
    sign = 2.0 * y - 1.0
    margin, target = np.zeros(len(y)), sign
    for number in numbers:
        rng = np.random.default_rng([settings["seed"], number])
        counts = (rng.binomial(n, settings["rate"]) if settings["rate"] < 1 else n).astype(float)
        tree, at = grow(bins, settings["sizes"], counts, w, target, settings["depth"])
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.where(tree["w"] > 0, tree["s"] / tree["w"], 0.0)
        margin += (settings["step"] if number else 1.0) * value[at]
        target = 4.0 * sign / (1.0 + np.exp(np.minimum(2.0 * sign * margin, 700.0)))
        yield _node_rows(number, tree, settings["thresholds"], False, settings["binary"])


def _grown(cells: DataFrame, trees: int, parts: int, rule: Callable, settings: dict) -> DataFrame:
    """The nodes of all trees; every part holds all cells and grows its share of the trees."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        if not frames:
            return
        table = pd.concat(frames, ignore_index=True)
        bins = np.stack(table["bins"].to_numpy()).astype(np.int16)
        y, w, n = table["y"].to_numpy(float), table["w"].to_numpy(float), table["n"].to_numpy(np.int64)
        order = np.lexsort([w, y, *bins.T])  # the draws go by the place of a cell
        found = (np.ascontiguousarray(bins[order].T), y[order], w[order], n[order])
        for rows in rule(found, range(int(table["part"].iloc[0]), trees, parts), settings):
            nodes = [dict(zip(("id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild"), r[1])) for r in rows]
            for node, r in zip(nodes, rows):
                node["split"] = dict(zip(("featureIndex", "leftCategoriesOrThreshold", "numCategories"), r[1][-1]))
            yield pd.DataFrame({"treeID": [r[0] for r in rows], "nodeData": nodes})

    # At most MOST_BINS bins, whatever the number of rows.
    dealt = cells.sparkSession.range(0, parts, 1, parts).withColumnRenamed("id", "part").crossJoin(F.broadcast(cells))
    return dealt.mapInPandas(part, NODES)


def _save_model(spark, path: str, estimator, kind: str, tree_kind: str, nodes: DataFrame, tree_weights: Sequence[float], extra: dict) -> None:
    """Write a tree ensemble in the layout that Spark ML loads."""
    nodes.write.parquet(f"{path}/data")
    params = {p.name: v for p, v in estimator._paramMap.items()}
    defaults = {p.name: v for p, v in estimator._defaultParamMap.items()}
    head = {"timestamp": 0, "sparkVersion": spark.version, "paramMap": params, "defaultParamMap": defaults}
    shared = {x: params[x] for x in ("featuresCol", "labelCol", "maxDepth", "seed", "weightCol") if x in params}
    tree = {**head, "class": tree_kind, "paramMap": shared, "defaultParamMap": {}}
    rows = [(i, json.dumps({**tree, "uid": f"tree_{uuid.uuid4().hex[:12]}"}), float(w)) for i, w in enumerate(tree_weights)]
    spark.createDataFrame(rows, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    meta = {**head, "class": kind, "uid": estimator.uid, **extra}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/metadata")


def fit_cells(estimator, vectors: DataFrame, thresholds: Sequence[Sequence[float]], cells: DataFrame):
    """The model of ``estimator``, grown on ``cells``."""
    spark = vectors.sparkSession
    features = len(thresholds)
    groups = vectors.schema[estimator.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    binary = {a["idx"] for a in groups.get("binary", [])}
    settings = {
        "thresholds": [list(t) for t in thresholds],
        "sizes": [len(t) + 1 for t in thresholds],
        "binary": [i in binary for i in range(features)],
        "seed": estimator.getSeed() % 2**64,
        "depth": estimator.getMaxDepth(),
        "rate": estimator.getSubsamplingRate(),
    }
    path = scratch_path(spark, "model")
    if isinstance(estimator, GBTClassifier):
        rounds = estimator.getMaxIter()
        settings["step"] = estimator.getStepSize()
        nodes = _grown(cells, rounds, 1, _boosted, settings)
        weights = [1.0] + [estimator.getStepSize()] * (rounds - 1)
        kinds = ("org.apache.spark.ml.classification.GBTClassificationModel", "org.apache.spark.ml.regression.DecisionTreeRegressionModel")
        _save_model(spark, path, estimator, *kinds, nodes, weights, {"numFeatures": features, "numTrees": rounds})
        return GBTClassificationModel.load(path)
    trees, root = estimator.getNumTrees(), math.ceil(math.sqrt(features))
    chosen = {"all": features, "auto": root, "sqrt": root, "onethird": math.ceil(features / 3)}
    settings |= {"chosen": chosen[estimator.getFeatureSubsetStrategy()], "bootstrap": estimator.getBootstrap()}
    nodes = _grown(cells, trees, min(trees, 2 * spark.sparkContext.defaultParallelism), _forest, settings)
    kinds = ("org.apache.spark.ml.classification.RandomForestClassificationModel", "org.apache.spark.ml.classification.DecisionTreeClassificationModel")
    _save_model(spark, path, estimator, *kinds, nodes, [1.0] * trees, {"numFeatures": features, "numClasses": 2, "numTrees": trees})
    return RandomForestClassificationModel.load(path)


class CellFits:
    """Fits the estimators of one comparison; those with the same bins share the count of cells."""

    def __init__(self, vectors: DataFrame, rows: int):
        self.vectors, self.rows, self.counted = vectors, rows, {}

    def _cells(self, estimator) -> tuple | None:
        weight = estimator.getWeightCol() if estimator.isSet("weightCol") else None
        key = (estimator.getFeaturesCol(), estimator.getLabelCol(), weight, estimator.getMaxBins(), estimator.getSeed())
        if key not in self.counted:
            found, thresholds = None, find_thresholds(estimator, self.vectors)
            if thresholds:
                cells = stage(count_cells(estimator, self.vectors, thresholds), "cells")
                found = (thresholds, cells) if cells.count() * len(thresholds) <= MOST_BINS else None
            self.counted[key] = found
        return self.counted[key]

    def fit(self, estimator):
        """The model grown on cells; None where Spark ML is to fit the rows."""
        if self.rows > ROWS and supports(estimator) and (found := self._cells(estimator)):
            return fit_cells(estimator, self.vectors, *found)
        return None
