from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom.operators.perceptron import Perceptron, PerceptronSettings, first_weights, gradient, train, unpack


@pytest.fixture(scope="module")
def rings(spark):
    """Two classes that no line parts."""
    draw = np.random.default_rng(1)
    x = draw.normal(size=(1500, 2))
    y = (np.hypot(x[:, 0], x[:, 1]) < 1.1).astype(float)
    rows = [(i, float(b), r.tolist()) for i, (r, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id LONG, label DOUBLE, cells ARRAY<DOUBLE>").repartition(2).cache()


def test_gradient_equals_differences():
    draw = np.random.default_rng(0)
    layers = [3, 5, 4, 1]
    flat, rows, labels = first_weights(layers, 2), draw.normal(size=(30, 3)), draw.integers(0, 2, 30).astype(float)
    assert len(flat) == 3 * 5 + 5 + 5 * 4 + 4 + 4 + 1 and unpack(flat, layers)[1][0].shape == (5, 4)
    for alpha in (0.0, 0.5):
        _, slope = gradient(flat, layers, rows, labels, alpha)
        for k in range(0, len(flat), 3):
            step = np.zeros(len(flat))
            step[k] = 1e-6
            up, down = (gradient(flat + s * step, layers, rows, labels, alpha)[0] for s in (1, -1))
            assert slope[k] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_learns_what_no_line_can_part_and_stops(rings):
    settings = PerceptronSettings(hidden=(16,), rate=0.02, patience=4, max_rounds=60)
    layers, weights, shares = train(rings, features="cells", label="label", settings=settings)
    assert layers == [2, 16, 1] and max(shares) > 0.9
    assert len(shares) < 61  # it has stopped before the last round
    best = int(np.argmax(shares))
    assert all(s <= shares[best] + settings.tolerance for s in shares[best:])
    assert len(shares) - 1 - best >= settings.patience or len(shares) - 1 - best <= 60
    again = train(rings, features="cells", label="label", settings=settings)
    np.testing.assert_allclose(weights, again[1])


def test_a_larger_penalty_shrinks_the_weights(rings):
    sizes = []
    for alpha in (1e-4, 50.0):
        layers, weights, _ = train(rings, features="cells", label="label", settings=PerceptronSettings(hidden=(8,), alpha=alpha, max_rounds=6, patience=9, rate=0.02))
        sizes.append(sum(float((w * w).sum()) for w, _ in unpack(weights, layers)))
    assert sizes[1] < 0.7 * sizes[0]


def test_model_is_saved_and_small_tables_train(spark, rings, frame, tmp_path):
    vectors = rings.withColumn("features", array_to_vector("cells"))
    estimator = Perceptron(PerceptronSettings(hidden=(8, 4), max_rounds=5, rate=0.02)).setFeaturesCol("features").setLabelCol("label")
    fitted = Pipeline(stages=[SQLTransformer(statement="SELECT * FROM __THIS__"), estimator]).fit(vectors)
    first = {r.id: r.probability[1] for r in fitted.transform(vectors).collect()}
    fitted.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert {r.id: r.probability[1] for r in loaded.transform(vectors).collect()} == first and 0 < loaded.stages[-1].rounds <= 6
    assert all(0 < p < 1 for p in first.values())
    few = frame([(1.0, [0.5]), (0.0, [-0.5])], "label DOUBLE, cells ARRAY<DOUBLE>")
    layers, weights, _ = train(few, features="cells", label="label", settings=PerceptronSettings(hidden=(2,), max_rounds=2, held_out=0.0))
    assert layers == [1, 2, 1] and np.isfinite(weights).all()
    with pytest.raises(ValueError, match="no rows"):
        train(few.where("false"), features="cells", label="label")
