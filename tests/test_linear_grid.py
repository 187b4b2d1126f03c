from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom.operators import linear_grid
from riskloom.operators.linear_grid import Penalty, as_classifier, fit_logistic_grid, probabilities

SETTINGS = [Penalty(kind, s) for kind in ("l1", "l2") for s in (0.1, 0.01, 0.001, 1e-5)]


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(7)
    data = []
    for fold, width in ((0, 5), (1, 5), (2, 6)):  # folds may have features of their own
        x = draw.normal(size=(400, width)) * np.array([1.0, 1000.0, 0.01, 1.0, 5.0, 2.0])[:width] + 3.0
        x[:, 3] = x[:, 3] > 3.0
        y = draw.random(400) < 1 / (1 + np.exp(-(x[:, 0] - 3.0 + 0.002 * (x[:, 1] - 3.0) - x[:, 3])))
        data += [(fold, float(b), 1.0 + 2.0 * float(b), r.tolist()) for b, r in zip(y, x, strict=True)]
    return spark.createDataFrame(data, "fold INT, label DOUBLE, weight DOUBLE, features ARRAY<DOUBLE>").repartition(3).cache()


def test_all_together_equal_single_fits(rows):
    together = fit_logistic_grid(rows, SETTINGS, weight="weight")
    assert set(together) == {0, 1, 2} and all(len(m) == 8 for m in together.values())
    for fold, places in ((0, (1, 6)), (2, (2,))):
        for place in places:
            (alone,) = fit_logistic_grid(rows.where(f"fold = {fold}"), [SETTINGS[place]], weight="weight")[fold]
            np.testing.assert_allclose(together[fold][place].coefficients, alone.coefficients, rtol=1e-6, atol=1e-6)
            assert together[fold][place].intercept == pytest.approx(alone.intercept, abs=1e-6)


def test_equal_to_the_built_in_learner(rows):
    one = rows.where("fold = 1").withColumn("features", array_to_vector("features"))
    models = fit_logistic_grid(rows, SETTINGS, weight="weight")[1]
    for penalty, model in zip(SETTINGS, models, strict=True):
        learner = LogisticRegression(
            weightCol="weight", standardization=False, maxIter=4000, tol=1e-12, regParam=penalty.strength,
            elasticNetParam=1.0 if penalty.kind == "l1" else 0.0,
        )
        fitted = learner.fit(one)
        np.testing.assert_allclose(model.coefficients, fitted.coefficients.toArray(), rtol=2e-3, atol=2e-5)
        zero = np.abs(fitted.coefficients.toArray()) < 1e-12
        assert penalty.kind == "l2" or not np.abs(model.coefficients[zero]).any()


def test_number_of_jobs_does_not_follow_the_settings(rows, monkeypatch):
    calls = []
    plain = linear_grid._evaluated
    monkeypatch.setattr(linear_grid, "_evaluated", lambda *a: calls.append(len(a[1])) or plain(*a))
    models = fit_logistic_grid(rows, SETTINGS, weight="weight")
    assert len(calls) == max(m.passes for own in models.values() for m in own) < 80
    assert sum(m.passes for own in models.values() for m in own) > 8 * len(calls)


def test_built_in_model_scores_the_same(spark, rows):
    models = fit_logistic_grid(rows, SETTINGS)[0]
    df = rows.where("fold = 0").withColumn("chances", probabilities(F.col("features"), models))
    fitted = as_classifier(spark, models[3])
    scored = fitted.transform(df.withColumn("features", array_to_vector("features"))).select("chances", "probability").collect()
    assert all(r.chances[3] == pytest.approx(r.probability[1], abs=1e-12) for r in scored) and len(scored) == 400
    assert fit_logistic_grid(rows.where("false"), SETTINGS) == {}


def test_one_class_and_constant_features(frame):
    rows = [(0, 1.0, [1.0, 2.0])] * 20
    (model,) = fit_logistic_grid(frame(rows, "fold INT, label DOUBLE, features ARRAY<DOUBLE>"), [Penalty("l2", 0.1)])[0]
    assert np.abs(model.coefficients).max() < 1e-6 and model.intercept > 5


def test_all_levels_of_a_category_cost_no_passes(frame):
    """Levels beside the intercept leave a direction that only the penalty decides."""
    draw = np.random.default_rng(3)
    level, numbers = draw.integers(0, 5, 3000), draw.normal(size=(3000, 2)) * [3000.0, 50_000.0] + [4500.0, 250_000.0]
    x = np.c_[numbers, np.eye(5)[level]]
    y = (numbers[:, 0] + 300 * level + draw.normal(size=3000) * 400 < 2000).astype(float)
    w = np.where(y == 1, 3.0, 0.6)
    data = [(0, b, c, r) for b, c, r in zip(y.tolist(), w.tolist(), x.tolist(), strict=True)]
    settings = [Penalty(kind, 1 / (c * 3000)) for kind in ("l1", "l2") for c in (0.1, 0.5, 1.0, 2.0)]
    models = fit_logistic_grid(frame(data, "fold INT, label DOUBLE, weight DOUBLE, features ARRAY<DOUBLE>"), settings, weight="weight")[0]
    assert max(m.passes for m in models) <= 20
    for penalty, model in zip(settings, models, strict=True):
        b = model.coefficients
        rest = w * (1 / (1 + np.exp(-(x @ b + model.intercept))) - y) / w.sum()
        slope = rest @ x + (penalty.strength * b if penalty.kind == "l2" else 0.0)
        if penalty.kind == "l1":
            slope = np.where(b != 0, slope + penalty.strength * np.sign(b), np.maximum(np.abs(slope) - penalty.strength, 0.0))
        assert abs(rest.sum()) < 1e-9 and (np.abs(slope) / x.std(axis=0).clip(1.0)).max() < 1e-9


def test_many_features_take_gradients_only(rows, monkeypatch):
    few = fit_logistic_grid(rows, SETTINGS, weight="weight")
    monkeypatch.setattr(linear_grid, "CURVATURES", 0)
    many = fit_logistic_grid(rows, SETTINGS, weight="weight")
    for fold, models in few.items():
        for a, b in zip(models, many[fold], strict=True):
            np.testing.assert_allclose(a.coefficients, b.coefficients, rtol=1e-4, atol=1e-7)
            assert a.intercept == pytest.approx(b.intercept, abs=1e-4)


def test_lowest_of_singular_models():
    draw = np.random.default_rng(5)
    for _ in range(200):
        half = draw.normal(size=(4, 6))
        bend, slope = half.T @ half, half.T @ draw.normal(size=4)
        l1 = np.append(draw.uniform(0.01, 1.0, 5), 0.0)
        z = linear_grid.lowest(bend, slope, l1, draw.normal(size=6))
        steep = slope + bend @ z
        off = np.where(z != 0, np.abs(steep + l1 * np.sign(z)), np.maximum(np.abs(steep) - l1, 0.0))
        assert off.max() < 1e-9
