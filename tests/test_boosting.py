"""Leaf-wise boosting against a plain numpy booster that makes one split at a time."""

from __future__ import annotations

from dataclasses import asdict

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom.operators.boosting import (
    LEAST_GAIN, UNITS, BoostingModel, BoostingSettings, LeafwiseBoosting, Tree, root_histogram, train,
)

ROWS, WIDTH = 2000, 6


def sample():
    draw = np.random.default_rng(5)
    x = np.round(draw.normal(size=(ROWS, WIDTH)), 1)
    x[:, 3] = draw.integers(0, 2, ROWS)
    odds = 1.5 * x[:, 0] - x[:, 1] * x[:, 3] + np.where(x[:, 2] > 0.5, 1.0, -0.5)
    y = (draw.random(ROWS) < 1 / (1 + np.exp(-odds))).astype(float)
    x[draw.random(x.shape) < 0.08] = np.nan
    return x, y, np.where(y == 1, 2.0, 1.0)


def plain_trees(x, y, w, s: BoostingSettings):
    """The same trees by sorting values: one leaf at a time, every threshold, both ways for missing values."""
    share = (y * w).sum() / w.sum()
    base = float(np.log(share / (1 - share)))
    margin, trees = np.full(len(y), base), []
    borders = [np.unique(c[~np.isnan(c)]) for c in x.T]

    def score(g, h):
        return g / UNITS * (g / UNITS) / (h / UNITS + s.penalty) if h / UNITS + s.penalty > 0 else 0.0

    for _ in range(s.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint(w * (p - y) * UNITS).astype(int), np.rint(w * p * (1 - p) * UNITS).astype(int)

        def best_split(rows, depth):
            best = (-np.inf,)
            if s.max_depth is not None and depth >= s.max_depth:
                return best
            options = []
            for missing_left in (False, True):
                for f in range(x.shape[1]):
                    for border in borders[f]:
                        column = x[rows, f]
                        left = np.where(np.isnan(column), missing_left, column <= border)
                        sides = rows[left], rows[~left]
                        if min(map(len, sides)) < max(1, s.min_rows) or min(h[r].sum() for r in sides) < s.min_hessian * UNITS:
                            continue
                        gain = sum(score(g[r].sum(), h[r].sum()) for r in sides) - score(g[rows].sum(), h[rows].sum())
                        options.append((gain, f, border, missing_left, *sides))
            for option in options:
                if option[0] > best[0]:
                    best = option
            return best

        leaves = [(np.arange(len(y)), 0, best_split(np.arange(len(y)), 0))]
        while len(leaves) < s.max_leaves:
            at = max(range(len(leaves)), key=lambda i: leaves[i][2][0])
            if leaves[at][2][0] <= LEAST_GAIN:
                break
            rows, depth, split = leaves.pop(at)
            leaves += [(side, depth + 1, best_split(side, depth + 1)) for side in split[4:6]]
        for rows, _, _ in leaves:
            margin[rows] -= s.learning_rate * (g[rows].sum() / UNITS) / (h[rows].sum() / UNITS + s.penalty)
        trees.append(sorted(len(rows) for rows, _, _ in leaves))
    return base, trees, margin


@pytest.fixture(scope="module")
def table(spark):
    x, y, w = sample()
    rows = [(i, float(a), float(b), [None if np.isnan(v) else float(v) for v in r]) for i, (r, a, b) in enumerate(zip(x, y, w, strict=True))]
    return spark.createDataFrame(rows, "id long, label double, weight double, cells array<double>").repartition(3).cache()


@pytest.mark.parametrize("settings", [
    BoostingSettings(trees=3, max_leaves=9, learning_rate=0.3, min_rows=20, rewrite_every=2),
    BoostingSettings(trees=2, max_leaves=8, max_depth=3, learning_rate=0.5, penalty=1.0, min_hessian=1.0, min_rows=1),
])
def test_trees_equal_a_plain_booster(table, settings):
    x, y, w = sample()
    base, trees = train(table, features="cells", label="label", weight="weight", settings=settings)
    want_base, want_leaves, want_margin = plain_trees(x, y, w, settings)
    assert base == pytest.approx(want_base)
    assert [sorted(c for c, f in zip(t.cover, t.feature, strict=True) if f < 0) for t in trees] == want_leaves
    margin = np.full(len(y), base)
    for t in trees:
        for i, row in enumerate(x):
            node = 0
            while t.feature[node] >= 0:
                v = row[t.feature[node]]
                goes_left = t.missing_left[node] if np.isnan(v) else v <= t.threshold[node]
                node = t.left[node] if goes_left else t.right[node]
            margin[i] += t.value[node]
    np.testing.assert_allclose(margin, want_margin, rtol=1e-9, atol=1e-9)


def test_result_does_not_depend_on_partitions(table):
    settings = BoostingSettings(trees=2, max_leaves=6, row_share=0.8, column_share=0.7)
    first = train(table, features="cells", label="label", settings=settings)
    again = train(table.repartition(7, "id"), features="cells", label="label", settings=settings)
    assert first == again


def test_missing_values_learn_a_direction(frame):
    rows = [(1.0 if i % 2 else 0.0, [None if i % 2 else float(i % 7)]) for i in range(200)]
    _, (tree,) = train(frame(rows, "label double, cells array<double>"), features="cells", label="label", settings=BoostingSettings(trees=1, max_leaves=2, min_rows=1))
    assert tree.feature[0] == 0 and tree.threshold[0] == float("inf") and not tree.missing_left[0]
    assert tree.cover == [200, 100, 100] and tree.value[1] < 0 < tree.value[2]


def test_root_histogram_counts_every_row(table):
    histogram, cuts = root_histogram(table, features="cells", label="label")
    per_feature = histogram.groupBy("feature").agg(F.sum("rows").alias("n"), F.sum("gradient").alias("g")).collect()
    assert {r["n"] for r in per_feature} == {ROWS} and len({r["g"] for r in per_feature}) == 1
    x, _, _ = sample()
    assert [len(c) + 1 for c in cuts] == [len(np.unique(c[~np.isnan(c)])) for c in x.T]


def test_many_values_are_cut_at_quantiles(spark):
    wide = spark.range(20_000).selectExpr("CAST(id % 2 AS double) AS label", "array(CAST(id AS double)) AS cells")
    _, cuts = root_histogram(wide, features="cells", label="label", settings=BoostingSettings(max_bins=16))
    assert len(cuts[0]) == 15
    np.testing.assert_allclose(cuts[0], np.arange(1, 16) * 20_000 / 16, atol=100)


def test_estimator_learns_and_is_saved_with_a_pipeline(spark, table, tmp_path):
    vectors = table.withColumn("features", array_to_vector(F.transform("cells", lambda v: F.coalesce(v, F.lit(float("nan"))))))
    estimator = LeafwiseBoosting(BoostingSettings(trees=15, max_leaves=8), weightCol="weight").setFeaturesCol("features").setLabelCol("label")
    fitted = Pipeline(stages=[SQLTransformer(statement="SELECT * FROM __THIS__"), estimator]).fit(vectors)
    model = fitted.stages[-1]
    assert isinstance(model, BoostingModel) and sum(model.featureImportances.toArray()) == pytest.approx(1.0)
    assert model.featureImportances.toArray()[:3].sum() > 0.6
    scored = fitted.transform(vectors).select("id", "label", "probability").toPandas()
    chance = scored.probability.map(lambda v: v[1])
    assert ((chance > 2 / 3) == (scored.label == 1)).mean() > 0.75
    fitted.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(vectors).select("id", "label", "probability").toPandas()
    assert (again.sort_values("id").probability.map(list).tolist()) == (scored.sort_values("id").probability.map(list).tolist())


def test_one_class_and_constant_columns_give_stumps(frame):
    rows = [(1.0, [1.0, None])] * 30
    base, trees = train(frame(rows, "label double, cells array<double>"), features="cells", label="label", settings=BoostingSettings(trees=2))
    assert base > 10 and all(t.feature == [-1] for t in trees)
    assert asdict(Tree())["feature"] == []
    with pytest.raises(ValueError):
        train(frame([], "label double, cells array<double>"), features="cells", label="label")
