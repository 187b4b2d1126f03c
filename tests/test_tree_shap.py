"""Tree Shapley values against all subsets of features."""

from __future__ import annotations

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskloom.operators.boosting import BoostingSettings, LeafwiseBoosting, train
from riskloom.operators.tree_shap import counted_cover, expected_value, forest_of, leaf_paths, shap_arrays, tree_shap
from tests.test_boosting import sample


def known_value(tree, row, known, node=0):
    """Expected value of a tree when only the features in ``known`` are known."""
    f = tree["feature"][node]
    if f < 0:
        return tree["value"][node]
    left, right = tree["left"][node], tree["right"][node]
    if f in known:
        goes_left = tree["missing_left"][node] if np.isnan(row[f]) else row[f] <= tree["threshold"][node]
        return known_value(tree, row, known, left if goes_left else right)
    share = tree["cover"][left] / tree["cover"][node]
    return share * known_value(tree, row, known, left) + (1 - share) * known_value(tree, row, known, right)


def subsets(trees, row):
    d, out = len(row), []
    for f in range(d):
        others = [i for i in range(d) if i != f]
        total = 0.0
        for size in range(d):
            for chosen in combinations(others, size):
                weight = factorial(size) * factorial(d - size - 1) / factorial(d)
                total += weight * sum(known_value(t, row, {*chosen, f}) - known_value(t, row, set(chosen)) for t in trees)
        out.append(total)
    return out


@pytest.fixture(scope="module")
def boosted(spark):
    x, y, _ = sample()
    rows = [(i, float(b), [None if np.isnan(v) else float(v) for v in r]) for i, (r, b) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "id long, label double, cells array<double>")
    base, trees = train(df, features="cells", label="label", settings=BoostingSettings(trees=4, max_leaves=12, learning_rate=0.4))
    return df, x, base, [vars(t) for t in trees]


def test_values_equal_all_subsets(boosted):
    df, x, base, trees = boosted
    assert any(len({f for f, _, _ in path}) < sum(len(t) for _, _, t in path) for tree in trees for _, path in leaf_paths(tree))
    names = [f"f{i}__num" for i in range(x.shape[1])]
    chosen = df.where("id % 80 = 0")
    values = tree_shap(chosen, id_column="id", vector="cells", base=base, trees=trees, names=names)
    got = {(r.client_id, r.source_feature): r.shap_value for r in values.collect()}
    assert len(got) == 25 * len(names)
    for i in range(0, len(x), 80):
        np.testing.assert_allclose([got[i, f"f{k}"] for k in range(len(names))], subsets(trees, x[i]), atol=1e-12)


def test_leaves_without_training_rows_count_where_a_row_reaches_them(frame):
    tree = {"feature": [0, 1, -1, -1, 2, -1, -1], "threshold": [0.0, 0.0, 0.0, 0.0, 5.0, 0.0, 0.0], "missing_left": [False] * 7,
            "left": [1, 2, 0, 0, 5, 0, 0], "right": [4, 3, 0, 0, 6, 0, 0], "value": [0.0, 0.0, 1.0, 2.0, 0.0, 3.0, 4.0]}
    rows = [(1, [-1.0, -1.0, 9.0]), (2, [-1.0, -1.0, 1.0]), (3, [-2.0, -1.0, 1.0])]
    df = frame(rows, "id long, cells array<double>")
    (counted,) = counted_cover(df, cells="cells", trees=[tree])
    assert counted["cover"] == [3, 3, 3, 0, 0, 0, 0]
    asked = [*rows, (4, [1.0, 1.0, 1.0]), (5, [-1.0, 1.0, 9.0])]
    values = shap_arrays(frame(asked, "id long, cells array<double>"), id_column="id", cells="cells", base=0.5, trees=[counted])
    reached = {**counted, "cover": [3, 3, 3, 0, 1e-300, 5e-301, 5e-301]}
    for r in values.collect():
        np.testing.assert_allclose(r["values"], subsets([reached], dict(asked)[r.client_id]), atol=1e-12)


def test_every_client_adds_up_to_its_margin(boosted):
    df, x, base, trees = boosted
    cells = df.withColumn("cells", F.transform("cells", lambda v: F.coalesce(v, F.lit(float("nan")))))
    got = {r.client_id: (sum(r["values"]), r.base_value) for r in shap_arrays(cells, id_column="id", cells="cells", base=base, trees=trees).collect()}
    everything = set(range(x.shape[1]))
    assert {b for _, b in got.values()} == {expected_value(base, trees)}
    for i, row in enumerate(x):
        assert sum(got[i]) == pytest.approx(base + sum(known_value(t, row, everything) for t in trees), abs=1e-9)
    assert shap_arrays(cells.where("false"), id_column="id", cells="cells", base=base, trees=trees).count() == 0


def test_built_in_forests_are_explained(spark):
    x, y, _ = sample()
    x = np.nan_to_num(x)
    df = spark.createDataFrame([(i, float(b), *map(float, r)) for i, (r, b) in enumerate(zip(x, y, strict=True))], "id long, label double, a double, b double, c double, d double, e double, f double")
    vectors = VectorAssembler(inputCols=list("abcdef"), outputCol="features").transform(df)
    for estimator in (RandomForestClassifier(numTrees=3, maxDepth=4, seed=1), GBTClassifier(maxIter=3, maxDepth=3, seed=1), DecisionTreeClassifier(maxDepth=4)):
        model = estimator.fit(vectors)
        base, trees = forest_of(model)
        values = tree_shap(vectors.where("id < 40"), id_column="id", vector="features", base=base, trees=trees, names=[f"{c}__num" for c in "abcdef"])
        totals = {r.client_id: r.total for r in values.groupBy("client_id").agg((F.sum("shap_value") + F.max("base_value")).alias("total")).collect()}
        for r in model.transform(vectors.where("id < 40")).collect():
            want = r.probability[1]
            if isinstance(estimator, GBTClassifier):
                want = 0.5 * np.log(want / (1 - want))
            assert totals[r.id] == pytest.approx(want, abs=1e-9)
        one = {r.source_feature: r.shap_value for r in values.where("client_id = 3").collect()}
        np.testing.assert_allclose([one[c] for c in "abcdef"], subsets(trees, x[3]), atol=1e-9)


def test_the_boosters_own_model_is_explained(spark, boosted):
    df, x, _, _ = boosted
    vectors = df.select("id", "label", F.transform("cells", lambda v: F.coalesce(v, F.lit(0.0))).alias("cells"))
    from pyspark.ml.functions import array_to_vector

    vectors = vectors.withColumn("features", array_to_vector("cells"))
    model = LeafwiseBoosting(BoostingSettings(trees=3, max_leaves=6)).setFeaturesCol("features").setLabelCol("label").fit(vectors)
    base, trees = forest_of(model)
    values = tree_shap(vectors, id_column="id", vector="features", base=base, trees=trees, names=[f"f{i}__num" for i in range(6)])
    totals = values.groupBy("client_id").agg((F.sum("shap_value") + F.max("base_value")).alias("total"))
    scored = model.transform(vectors).select(F.col("id").alias("client_id"), "probability")
    for r in totals.join(scored, "client_id").collect():
        assert 1 / (1 + np.exp(-r.total)) == pytest.approx(r.probability[1], abs=1e-9)
