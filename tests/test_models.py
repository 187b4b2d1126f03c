from __future__ import annotations

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import explain, leaderboard
from riskloom.operators.decisions import batch_predictions, decide, positive_probability, score_with_function
from riskloom.plans.candidates import BASE_CANDIDATES, TrainingShape, expand_candidates, grid
from riskloom.plans.experiment import (
    BusinessCostEvaluator,
    feature_columns,
    resolve_champion,
    run_experiment,
    training_matrix,
)
from riskloom.plans.preprocessing import fit_preparation
from riskloom.session import scratch_path
from riskloom.settings import ExperimentSettings
from riskloom.sources.models import ScoringBundle, load_bundle, save_bundle
from tests.conftest import records


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(160):
        x, s = float(rng.normal()), "ab"[i % 2]
        y = int(x + (0.5 if s == "a" else 0.0) + rng.normal() * 0.4 > 0.9)
        rows.append((i, x if i % 9 else None, s if i % 11 else None, y))
    return spark.createDataFrame(rows, "SK_ID_CURR LONG, x DOUBLE, s STRING, TARGET INT")


SETTINGS = ExperimentSettings(folds=2)


SMALL_GRIDS = {
    "logistic_regression": dict(C=[1.0], penalty=["l2"], max_iter=[20]),
    "random_forest": dict(n_estimators=[3], max_depth=[None], min_samples_leaf=[1]),
    "boosting_shallow": dict(n_estimators=[2], learning_rate=[0.1], max_depth=[2]),
    "boosting_leafy": dict(n_estimators=[2], learning_rate=[0.1], num_leaves=[3]),
    "mlp": dict(hidden_layer_sizes=[(3,)], alpha=[1e-4], max_iter=[4]),
}


@pytest.mark.parametrize(
    ("model", "strategy"),
    zip(SMALL_GRIDS, ["smote", "baseline", "borderline_smote", "smote_under", "adasyn"], strict=True),
)
def test_every_model_fits_with_sampling_inside_the_folds(table, model, strategy):
    base = {model: replace(BASE_CANDIDATES[model], grid=grid(**SMALL_GRIDS[model]))}
    results, outcomes, best = run_experiment(table, expand_candidates(sampling=[strategy], base=base), SETTINGS)
    outcome = outcomes[best]
    assert outcome.oof.count() + outcome.holdout.count() == 160
    assert outcome.oof.filter("probability BETWEEN 0 AND 1").count() == outcome.oof.count()
    assert results.first()["sampling_strategy"] == strategy


def test_candidate_names_and_unknown_names():
    names = expand_candidates(["logistic_regression", "mlp"], ["baseline", "smote"])
    assert list(names) == ["logistic_regression", "logistic_regression__smote", "mlp", "mlp__smote"]
    assert names["mlp"].scaled and not names["mlp"].weighted
    assert expand_candidates(["boosting_shallow"])["boosting_shallow"].weighted
    assert not expand_candidates(["boosting_shallow"], ["smote"])["boosting_shallow__smote"].weighted
    for bad in ({"models": ["nope"]}, {"sampling": ["nope"]}):
        with pytest.raises(ValueError, match="Unknown"):
            expand_candidates(**bad)


def test_estimators_build(spark):
    shape = TrainingShape(rows=100, width=3)
    for candidate in BASE_CANDIDATES.values():
        for params in candidate.grid:
            assert candidate.build(params, shape, 1).__class__.__name__ == candidate.estimator_class


def test_preparation_imputes_and_zeroes_unknown_categories(spark, table):
    fitted = fit_preparation(table.select("x", "s"))
    fresh = spark.createDataFrame([(None, "zzz"), (1.0, None)], "x DOUBLE, s STRING")
    rows = [list(r[0]) for r in fitted.transform(fresh).select(vector_to_array("features")).collect()]
    middle = float(np.median([r["x"] for r in table.collect() if r["x"] is not None]))
    assert rows[0] == [pytest.approx(middle), 0.0, 0.0] and rows[1][0] == 1.0 and sum(rows[1][1:]) == 1.0
    names = explain.feature_names(fitted.transform(table))
    assert names == ["x__num", "s__oh_a", "s__oh_b"]
    assert [explain.source_of(n) for n in names] == [("x", "numeric"), ("s", "categorical"), ("s", "categorical")]


def test_training_matrix_weights_and_sampling(table):
    preparation = fit_preparation(table.select("x", "s"))
    balanced = expand_candidates(["logistic_regression"])["logistic_regression"]
    sums = {r["label"]: r["w"] for r in training_matrix(table, preparation, balanced, SETTINGS)
            .groupBy("label").agg(F.sum("class_weight").alias("w")).collect()}
    assert sums[0] == pytest.approx(sums[1])
    ratio = expand_candidates(["boosting_shallow"])["boosting_shallow"]
    assert training_matrix(table, preparation, ratio, SETTINGS).filter("label = 0").first()["class_weight"] == 1.0


@pytest.fixture(scope="module")
def experiment(table):
    base = {"logistic_regression": replace(BASE_CANDIDATES["logistic_regression"], grid=grid(C=[0.01, 1.0], penalty=["l2"]))}
    return run_experiment(table, expand_candidates(base=base), SETTINGS)


def test_experiment(table, experiment):
    results, outcomes, best = experiment
    row, outcome = results.first(), outcomes[best]
    assert best == "logistic_regression" and 0.5 < row["holdout_roc_auc"] <= 1.0
    assert outcome.oof.count() + outcome.holdout.count() == 160
    assert outcome.oof.join(outcome.holdout, "SK_ID_CURR").count() == 0
    assert outcome.cv_results.count() == 2
    assert row["true_negatives"] + row["false_positives"] + row["false_negatives"] + row["true_positives"] == outcome.holdout.count()
    flagged = outcome.holdout.filter(F.col("probability") >= row["threshold"]).count()
    assert outcome.holdout.agg(F.sum("prediction")).first()[0] == flagged


def test_views(experiment):
    results = experiment[0]
    other = results.withColumns({"model_name": F.lit("worse"), "cv_business_cost": F.col("cv_business_cost") + 1})
    both = results.unionByName(other)
    view = leaderboard.cv_view(both).collect()
    assert [r["selected_as_best"] for r in view] == [True, False] and leaderboard.champion(both).first()["model_name"] == "logistic_regression"
    assert leaderboard.holdout_view(both).columns[0] == "selected_as_best" and leaderboard.threshold_view(both).count() == 2
    performance = leaderboard.performance_view(both, {"logistic_regression": "LogisticRegression"})
    assert leaderboard.best_model_view(performance).first()["family"] == "linear"
    assert [r["scope"] for r in leaderboard.runs_view(both, campaign_name="c").collect()] == ["campaign", "model", "model"]


def test_overview(table):
    row = leaderboard.campaign_overview(table, campaign_name="My Run!", target="TARGET", facts={"cv_folds": 2}).first()
    assert (row["campaign_slug"], row["sampled_rows"], row["holdout_rows"], row["cv_folds"]) == ("my_run", 160, 0, 2)


def test_bundle_scoring_and_external_function(spark, table, experiment):
    outcome = experiment[1]["logistic_regression"]
    schema = feature_columns(table, SETTINGS).schema
    schema["x"].nullable = False
    bundle = load_bundle(spark, save_bundle(spark, ScoringBundle(outcome.model, 0.4, schema), scratch_path(spark, "b")))
    assert bundle.threshold == 0.4 and [f.required for f in bundle.request_fields()] == [True, False]
    scored = batch_predictions(table, bundle.model, id_column="SK_ID_CURR", threshold=0.4)
    assert all(r["default_prediction"] == int(r["default_probability"] >= 0.4) for r in scored.collect())
    outside = score_with_function(table.fillna({"x": 0.0}), lambda f: 1 / (1 + np.exp(-f["x"])), keep=["SK_ID_CURR"], features=["x"], threshold=0.5)
    assert {r["credit_decision"] for r in outside.collect()} == {"approved", "refused"}


def test_decisions(frame):
    df = frame([(0.10,), (0.22,), (0.80,)], "p DOUBLE")
    rows = records(decide(df, probability="p", threshold=0.22))
    assert [r["predicted_default"] for r in rows] == [0, 1, 1]
    assert [r["credit_decision"] for r in rows] == ["approved", "refused", "refused"]
    for bad in (-0.1, 1.1):
        with pytest.raises(ValueError, match="between 0 and 1"):
            decide(df, probability="p", threshold=bad)


def test_champion_resolution():
    found = {"model_name": "gbt", "sampling_strategy": "smote", "params": {"depth": 4, "rounds": 9}, "threshold": 0.22}
    same = dict(model_name="gbt", sampling_strategy="smote")
    assert resolve_champion(found, **same, params={"depth": 6}) == ({"depth": 6, "rounds": 9}, 0.22)
    assert resolve_champion(found, **same, threshold=0.5)[1] == 0.5
    assert resolve_champion(found, model_name="lr", sampling_strategy="baseline", threshold=0.1) == ({}, 0.1)
    with pytest.raises(ValueError, match="No known business threshold"):
        resolve_champion(None, **same)


def test_explanations_add_up(table, experiment):
    model = experiment[1]["logistic_regression"].model
    prepared = model.transform(table)
    names, fitted = explain.feature_names(prepared), model.stages[-1]
    plain = prepared.select("SK_ID_CURR", "features", positive_probability().alias("p"))
    linear = explain.linear_shap(plain, id_column="SK_ID_CURR", vector="features", coefficients=fitted.coefficients.toArray(), names=names)
    total = linear.groupBy("client_id").agg(F.sum("shap_value").alias("t")).agg(F.avg("t")).first()[0]
    assert total == pytest.approx(0.0, abs=1e-9)

    chosen = explain.extreme_clients(plain, 2, id_column="SK_ID_CURR", probability="p")
    background = plain.filter("SK_ID_CURR = 5").select("SK_ID_CURR", "features")
    values = explain.permutation_shap(chosen.select("SK_ID_CURR", "features"), fitted, id_column="SK_ID_CURR",
                                      vector="features", names=names, background=background, permutations=2)
    base = plain.filter("SK_ID_CURR = 5").first()["p"]
    sums = {r["client_id"]: r["t"] for r in values.groupBy("client_id").agg(F.sum("shap_value").alias("t")).collect()}
    for r in chosen.collect():
        assert sums[r["SK_ID_CURR"]] == pytest.approx(r["p"] - base)
    clients = chosen.select(F.col("SK_ID_CURR").alias("client_id"), F.col("p").alias("predicted_probability"))
    local = explain.local_shap(values, clients, top=1, by_source=True)
    assert local.count() == len(sums) and explain.global_shap_by_source(values).count() == 2


def test_importance(spark, experiment):
    fitted = experiment[1]["logistic_regression"].model.stages[-1]
    importances = explain.importance_table(spark, fitted, ["x__num", "s__oh_a", "s__oh_b"])
    assert explain.importance_by_source(importances).count() == 2

    class Opaque:
        pass

    assert explain.native_importance(Opaque()) is None


def test_evaluator(table):
    preparation = fit_preparation(table.select("x", "s"))
    prepared = preparation.transform(table).withColumn("label", F.col("TARGET"))
    scored = LogisticRegression().fit(prepared).transform(prepared)
    evaluator = BusinessCostEvaluator()
    assert evaluator.isLargerBetter() and -1.0 < evaluator.evaluate(scored) <= 0.0
