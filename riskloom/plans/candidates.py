"""Candidate models: estimators, parameter grids and their crossing with sampling strategies."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import product

from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier

from riskloom.operators.boosting import BoostingSettings, LeafwiseBoosting
from riskloom.operators.perceptron import Perceptron, PerceptronSettings
from riskloom.operators.rebalance import strategies


@dataclass(frozen=True)
class TrainingShape:
    """What an estimator factory may need to know about its training table."""

    rows: int
    width: int


@dataclass(frozen=True)
class Candidate:
    name: str
    base_name: str
    estimator_class: str
    build: Callable[[Mapping, TrainingShape, int], Estimator]
    grid: tuple[Mapping, ...]
    sampling: str = "baseline"
    scaled: bool = False
    weighting: str | None = None  # "balanced", "positive_ratio" or None
    together: bool = False  # all settings of all folds are logistic regressions, trained in the same passes

    @property
    def weighted(self) -> bool:
        """Whether rows are weighted: a positive-class ratio only applies to unsampled data."""
        return self.weighting == "balanced" or (self.weighting == "positive_ratio" and self.sampling == "baseline")


def grid(**axes: Sequence) -> tuple[Mapping, ...]:
    return tuple(dict(zip(axes, values)) for values in product(*axes.values()))


WEIGHT = "class_weight"


def _weight_args(weighted: bool) -> dict:
    return {"weightCol": WEIGHT} if weighted else {}


def _logistic(params: Mapping, shape: TrainingShape, seed: int) -> Estimator:
    # The penalty strength is given as its inverse, relative to the summed loss.
    return LogisticRegression(
        maxIter=int(params.get("max_iter", 4000)), standardization=False,
        regParam=1.0 / (params["C"] * shape.rows), elasticNetParam=1.0 if params["penalty"] == "l1" else 0.0,
        **_weight_args(params.get("weighted", False)),
    )


DEEPEST_TREE = 30  # the library's own ceiling: trees "without limit" end there


def _forest(params: Mapping, shape: TrainingShape, seed: int) -> Estimator:
    return RandomForestClassifier(
        numTrees=params["n_estimators"], maxDepth=params["max_depth"] or DEEPEST_TREE, seed=seed,
        minInstancesPerNode=params["min_samples_leaf"], **_weight_args(params.get("weighted", False)),
    )


def _shallow_boosting(params: Mapping, shape: TrainingShape, seed: int) -> Estimator:
    # with as many leaves as the depth allows, trees grow level by level
    depth = params["max_depth"]
    settings = BoostingSettings(
        trees=params["n_estimators"], learning_rate=params["learning_rate"], max_depth=depth, max_leaves=2**depth,
        min_rows=1, min_hessian=1.0, penalty=1.0, row_share=0.8, column_share=0.8, seed=seed,
    )
    return LeafwiseBoosting(settings, **_weight_args(params.get("weighted", False)))


def _leafy_boosting(params: Mapping, shape: TrainingShape, seed: int) -> Estimator:
    settings = BoostingSettings(
        trees=params["n_estimators"], learning_rate=params["learning_rate"], max_leaves=params["num_leaves"],
        column_share=0.8, seed=seed,
    )
    return LeafwiseBoosting(settings, **_weight_args(params.get("weighted", False)))


def _perceptron(params: Mapping, shape: TrainingShape, seed: int) -> Estimator:
    return Perceptron(PerceptronSettings(
        hidden=tuple(params["hidden_layer_sizes"]), alpha=params["alpha"], max_rounds=int(params.get("max_iter", 300)), seed=seed
    ))


# ---- Fixed values: candidate models and their grids ---------------------------------------------
BASE_CANDIDATES = {
    c.name: c
    for c in [
        Candidate("logistic_regression", "logistic_regression", "LogisticRegression", _logistic,
                  grid(C=[0.1, 0.5, 1.0, 2.0], penalty=["l1", "l2"]), weighting="balanced", together=True),
        Candidate("random_forest", "random_forest", "RandomForestClassifier", _forest,
                  grid(n_estimators=[300], max_depth=[None, 16], min_samples_leaf=[1, 5]), weighting="balanced"),
        Candidate("boosting_shallow", "boosting_shallow", "LeafwiseBoosting", _shallow_boosting,
                  grid(n_estimators=[300, 500], learning_rate=[0.03, 0.05], max_depth=[4, 6]),
                  weighting="positive_ratio"),
        Candidate("boosting_leafy", "boosting_leafy", "LeafwiseBoosting", _leafy_boosting,
                  grid(n_estimators=[300, 500], learning_rate=[0.03, 0.05], num_leaves=[31, 63]),
                  weighting="balanced"),
        Candidate("mlp", "mlp", "Perceptron", _perceptron,
                  grid(hidden_layer_sizes=[(64,), (64, 32)], alpha=[1e-4, 1e-3]), scaled=True),
    ]
}
# -----------------------------------------------------------------------------------------------


def expand_candidates(
    models: Sequence[str] | None = None,
    sampling: Sequence[str] | None = None,
    *,
    base: Mapping[str, Candidate] = BASE_CANDIDATES,
) -> dict[str, Candidate]:
    """Model x sampling strategy; a sampled variant is named ``model__strategy``."""
    chosen = list(models or base)
    unknown = [m for m in chosen if m not in base]
    if unknown:
        raise ValueError(f"Unknown model names: {unknown}")
    expanded = {}
    for model, strategy in product(chosen, strategies(sampling)):
        name = model if strategy == "baseline" else f"{model}__{strategy}"
        expanded[name] = replace(base[model], name=name, sampling=strategy)
    return expanded
