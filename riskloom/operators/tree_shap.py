"""Exact Shapley values of tree ensembles, for all rows in vectorised batches.

The game of a row gives a set of features the ensemble's expected value when only they are known: at a split on an
unknown feature a row goes both ways, in the shares of the training rows (``cover``). For one leaf this is its value
times a product over the features of its path, each with the share of training rows that follow the path there, or,
if it is known, 0 or 1 as the row follows it itself. The coefficients of that product by the number of known features
come from a dynamic programme over the path (one step a feature), and undoing one step gives those without a feature:
d squared steps for a path of d features, instead of 2 to the power of d sets, each step for all rows of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.explain import feature_mapping

#: Rows explained at a time in a task.
BATCH_ROWS = 4096


def leaf_paths(tree: Mapping) -> list[tuple[float, list[tuple[int, float, list[tuple[float, bool, bool]]]]]]:
    """(value, path) of every leaf; a path has each feature once: its share of training rows and its tests.

    A test is (largest value that goes left, whether missing values go left, whether the path goes left). Below a node
    that no training row has reached, both ways have the same share.
    """
    found = []
    waiting: list[tuple[int, dict]] = [(0, {})]
    while waiting:
        node, path = waiting.pop()
        feature = tree["feature"][node]
        if feature < 0:
            found.append((tree["value"][node], [(f, share, tests) for f, (share, tests) in path.items()]))
            continue
        for side, goes_left in (("left", True), ("right", False)):
            child = tree[side][node]
            share, tests = path.get(feature, (1.0, []))
            share *= tree["cover"][child] / tree["cover"][node] if tree["cover"][node] else 0.5
            test = (tree["threshold"][node], bool(tree["missing_left"][node]), goes_left)
            waiting.append((child, {**path, feature: (share, [*tests, test])}))
    return found


def expected_value(base: float, trees: Sequence[Mapping]) -> float:
    """The ensemble's value when nothing is known: the same for every row."""
    return base + sum(value * float(np.prod([share for _, share, _ in path])) for tree in trees for value, path in leaf_paths(tree))


def _explainer():
    """A function that gives the Shapley values of an array of rows: one column per slot."""

    def explain(cells: np.ndarray, paths: list) -> np.ndarray:
        values = np.zeros_like(cells)
        for value, path in paths:
            d = len(path)
            if not d or not value:
                continue
            follows = []
            for feature, _, tests in path:
                cell = cells[:, feature]
                absent = np.isnan(cell)
                ok = np.ones(len(cells), bool)
                for border, missing_left, goes_left in tests:
                    ok &= np.where(absent, missing_left, cell <= border) == goes_left
                follows.append(ok.astype(float))
            known = np.zeros((d + 1, len(cells)))  # by the number of known features
            known[0] = 1.0
            for one, (_, share, _) in zip(follows, path, strict=True):
                known[1:] = known[1:] * share + known[:-1] * one
                known[0] *= share
            weights = [factorial(k) * factorial(d - 1 - k) / factorial(d) for k in range(d)]
            for one, (feature, share, _) in zip(follows, path, strict=True):
                # without this feature: divide by (share + one x), from the top where one is 1, else by the share; where
                # both are 0 the feature adds nothing
                rest, total = known[d], np.zeros(len(cells))
                for k in range(d - 1, -1, -1):
                    without = np.where(one > 0, rest, known[k] / share if share else 0.0)
                    total += weights[k] * without
                    rest = known[k] - share * rest
                values[:, feature] += value * (one - share) * total
        return values

    return explain


def shap_arrays(df: DataFrame, *, id_column: str, cells: str, base: float, trees: Sequence[Mapping]) -> DataFrame:
    """client_id, cells, values (Shapley values by slot, on the margin scale) and base_value for every row.

    The values of a row and its ``base_value`` add up to its margin. NaN is a missing value. No rows give no rows.
    """
    paths = [p for tree in trees for p in leaf_paths(tree)]
    centre, explain, size = expected_value(base, trees), _explainer(), BATCH_ROWS
    rows = df.select(F.col(id_column).alias("client_id"), F.col(cells).alias("cells"))
    kind = rows.schema["client_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, size):
                batch = whole.slice(start, size)
                own = np.asarray(batch["cells"].flatten(), float).reshape(batch.num_rows, -1)
                found = explain(own, paths)
                offsets = pa.array(np.arange(batch.num_rows + 1) * own.shape[1], pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(a.ravel())) for a in (own, found)]
                yield pa.RecordBatch.from_arrays([batch["client_id"], *lists, pa.array(np.full(len(own), centre))], ["client_id", "cells", "values", "base_value"])

    return rows.mapInArrow(run, f"client_id {kind}, cells array<double>, values array<double>, base_value double")


def tree_shap(df: DataFrame, *, id_column: str, vector: str, base: float, trees: Sequence[Mapping], names: Sequence[str]) -> DataFrame:
    """The long explanation table: one row per client and slot, with ``shap_value`` and ``base_value``."""
    array = df.schema[vector].dataType.typeName() == "array"
    cells = F.transform(F.col(vector) if array else vector_to_array(vector), lambda v: F.coalesce(v.cast("double"), F.lit(float("nan"))))
    arrays = shap_arrays(df.withColumn("__cells", cells), id_column=id_column, cells="__cells", base=base, trees=trees)
    pairs = F.posexplode(F.arrays_zip("cells", "values")).alias("position", "pair")
    long = arrays.select("client_id", "base_value", pairs)
    mapping = F.broadcast(feature_mapping(df.sparkSession, names))  # one row per slot of the model
    return long.join(mapping, "position").select(
        "client_id", "transformed_feature", "source_feature", "feature_kind", F.col("pair.cells").alias("feature_value"),
        F.col("pair.values").alias("shap_value"), "base_value",
    )


def counted_cover(df: DataFrame, *, cells: str, trees: Sequence[Mapping]) -> list[dict]:
    """The trees with ``cover`` counted over the rows of ``df``: for trees that come without their training counts."""
    trees = [{**tree, "cover": [0] * len(tree["feature"])} for tree in trees]
    plain = [(t["feature"], t["threshold"], t["missing_left"], t["left"], t["right"]) for t in trees]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(t[0]), np.int64) for t in plain]
        for batch in batches:
            own = np.asarray(batch["cells"].flatten(), float).reshape(batch.num_rows, -1)
            for count, (feature, border, missing_left, left, right) in zip(counts, plain, strict=True):
                inside = {0: np.arange(len(own))}
                for node in range(len(feature)):  # children come after their parents
                    rows = inside.pop(node)
                    count[node] += len(rows)
                    if feature[node] >= 0:
                        cell = own[rows, feature[node]]
                        ok = np.where(np.isnan(cell), missing_left[node], cell <= border[node]).astype(bool)
                        inside[left[node]], inside[right[node]] = rows[ok], rows[~ok]
        rows = [(t, node, int(n)) for t, count in enumerate(counts) for node, n in enumerate(count)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["tree", "node", "n"])

    parts = df.select(F.col(cells).alias("cells")).mapInArrow(run, "tree long, node long, n long")
    for row in parts.groupBy("tree", "node").agg(F.sum("n").alias("n")).collect():  # as many rows as the trees have nodes
        trees[row["tree"]]["cover"][row["node"]] = row["n"]
    return trees


def forest_of(model: Model) -> tuple[float, list[dict]]:
    """Base value and trees of the library's booster or of a built-in tree model.

    Built-in boosted trees answer with a margin (the probability is that of twice the margin), forests and single
    trees with the probability of class 1.
    """
    if hasattr(model, "forest"):
        forest = model.forest()
        return forest["base"], forest["trees"]
    if hasattr(model, "treeWeights"):
        boosted = not hasattr(model, "numClasses") or type(model).__name__.startswith("GBT")
        weights = list(model.treeWeights)
        total = 1.0 if boosted else sum(weights)
        return 0.0, [_built_in(t._java_obj.rootNode(), w / total, boosted) for t, w in zip(model.trees, weights, strict=True)]
    return 0.0, [_built_in(model._java_obj.rootNode(), 1.0, False)]


def _built_in(root, weight: float, boosted: bool) -> dict:
    """The nodes of one built-in tree. Its splits have no rule of their own for missing values: NaN goes right."""
    tree: dict = {c: [] for c in ("feature", "threshold", "missing_left", "left", "right", "value", "cover")}

    def add(node) -> int:
        at = len(tree["feature"])
        stats = node.impurityStats()
        cover = float(stats.count())
        value = float(node.prediction())
        if not boosted:
            value = float(stats.stats()[1]) / cover if cover else 0.0
        for name, cell in {"feature": -1, "threshold": 0.0, "missing_left": False, "left": 0, "right": 0, "value": weight * value, "cover": cover}.items():
            tree[name].append(cell)
        return at

    waiting = [(root, add(root))]
    while waiting:
        node, at = waiting.pop()
        if node.getClass().getSimpleName() != "InternalNode":
            continue
        split, sides = node.split(), [node.leftChild(), node.rightChild()]
        if split.getClass().getSimpleName() == "ContinuousSplit":
            border = float(split.threshold())
        else:
            left = sorted(split.leftCategories())
            if left not in ([0.0], [1.0]) or len(list(split.rightCategories())) != 1:
                raise ValueError("only numeric and two-valued slots can be explained")
            border, sides = 0.5, sides if left == [0.0] else sides[::-1]
        tree["feature"][at], tree["threshold"][at] = int(split.featureIndex()), border
        for side, child in zip(("left", "right"), sides, strict=True):
            tree[side][at] = add(child)
            waiting.append((child, tree[side][at]))
    return tree
