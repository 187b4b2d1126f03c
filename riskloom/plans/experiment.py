"""Model selection by business cost: grid x folds, out-of-fold threshold, hold-out check, champion.

The training table stays partitioned once with a fold column; the driver only submits fits. All fold
scores of a candidate land in one prediction table, and one grouped score curve rates every
(parameter set, fold) pair.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from riskloom.operators.decisions import positive_probability
from riskloom.operators.leaderboard import RESULT_SCHEMA, champion
from riskloom.operators.linear_grid import Penalty, as_classifier, fit_logistic_grid, probabilities
from riskloom.operators.rebalance import rebalance
from riskloom.operators.sampling import balanced_weights, class_weight_ratio, stratified_folds, stratified_split
from riskloom.operators.scorecurve import best_threshold, evaluate_threshold
from riskloom.plans.candidates import WEIGHT, Candidate, TrainingShape
from riskloom.plans.preprocessing import fit_preparation
from riskloom.session import materialize
from riskloom.settings import CostModel, ExperimentSettings

LABEL, FOLD = "label", "fold"


class BusinessCostEvaluator(Evaluator):
    """Negative cost at the best threshold, for Spark's own tuning classes (larger is better)."""

    def __init__(self, labelCol: str = LABEL, probabilityCol: str = "probability", cost: CostModel = CostModel()):
        super().__init__()
        self.label_column, self.probability_column, self.cost = labelCol, probabilityCol, cost

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(self.label_column, positive_probability(self.probability_column).alias("p"))
        return best_threshold(scored, label=self.label_column, score="p", cost=self.cost).first()["business_score"]

    def isLargerBetter(self) -> bool:
        return True


@dataclass
class CandidateOutcome:
    """A fitted candidate with its result row and its prediction tables."""

    candidate: Candidate
    params: Mapping
    result: dict
    model: PipelineModel
    cv_results: DataFrame
    oof: DataFrame
    holdout: DataFrame


def training_matrix(
    train: DataFrame, preparation: PipelineModel, candidate: Candidate, settings: ExperimentSettings
) -> DataFrame:
    """Prepared, rebalanced and weighted training rows: label, features and, if used, the weight."""
    data = settings.dataset
    prepared = preparation.transform(train).select(
        F.col(data.id_column).alias("id"), F.col(data.target).cast("int").alias(LABEL), "features"
    )
    if candidate.sampling != "baseline":
        arrays = prepared.withColumn("vector", vector_to_array("features")).drop("features")
        raised = rebalance(
            arrays, candidate.sampling, id_column="id", vector="vector", label=LABEL,
            settings=settings.rebalance, seed=data.seed,
        )
        prepared = raised.select("id", LABEL, array_to_vector("vector").alias("features"))
    if candidate.weighted and candidate.weighting == "balanced":
        prepared = balanced_weights(prepared, LABEL, WEIGHT)
    elif candidate.weighted:
        ratio = class_weight_ratio(prepared, LABEL).first()["ratio"]
        prepared = prepared.withColumn(WEIGHT, F.when(F.col(LABEL) == 1, float(ratio)).otherwise(1.0))
    return prepared


def _penalty(params: Mapping):
    """The penalty of a setting: its strength is given as its inverse, relative to the summed loss."""
    return lambda rows: Penalty(params["penalty"], 1.0 / (params["C"] * rows))


def _fit(matrix: DataFrame, candidate: Candidate, params: Mapping, settings: ExperimentSettings) -> Model:
    if candidate.together:
        rows = matrix.withColumn(FOLD, F.lit(0))
        weight = WEIGHT if candidate.weighted else None
        return as_classifier(matrix.sparkSession, fit_logistic_grid(rows, [_penalty(params)], fold=FOLD, label=LABEL, weight=weight)[0][0])
    facts = matrix.agg(F.count("*").alias("rows")).first()
    shape = TrainingShape(rows=facts["rows"], width=matrix.first()["features"].size)
    asked = {**params, "weighted": candidate.weighted}
    estimator = candidate.build(asked, shape, settings.dataset.seed)
    return estimator.setFeaturesCol("features").setLabelCol(LABEL).fit(matrix)


def _predictions(df: DataFrame, preparation: PipelineModel, model: Model, settings: ExperimentSettings) -> DataFrame:
    data = settings.dataset
    scored = model.transform(preparation.transform(df))
    return scored.select(
        F.col(data.id_column), F.col(data.target).cast("int").alias(data.target), positive_probability().alias("p")
    ).withColumnRenamed("p", "probability")


def feature_columns(df: DataFrame, settings: ExperimentSettings) -> DataFrame:
    data = settings.dataset
    return df.drop(data.target, *data.drop_columns, FOLD)


def _prepare(df: DataFrame, candidate: Candidate, settings: ExperimentSettings) -> PipelineModel:
    names = feature_columns(df, settings).columns
    chosen = df.select(*names)
    return fit_preparation(chosen, scale=candidate.scaled)


def cross_validate(train: DataFrame, candidate: Candidate, settings: ExperimentSettings) -> DataFrame:
    """(grid, fold, id, target, probability) for every parameter set and held-out fold."""
    if candidate.together:
        return _cross_validate_together(train, candidate, settings)
    pieces: list[DataFrame] = []
    for fold in range(settings.folds):
        seen = train.filter(F.col(FOLD) != fold)
        held = train.filter(F.col(FOLD) == fold)
        preparation = _prepare(seen, candidate, settings)
        matrix = training_matrix(seen, preparation, candidate, settings).persist(StorageLevel.MEMORY_AND_DISK)

        def run(indexed, matrix=matrix, held=held, preparation=preparation, fold=fold):
            index, params = indexed
            model = _fit(matrix, candidate, params, settings)
            return _predictions(held, preparation, model, settings).select(
                F.lit(index).alias("grid"), F.lit(fold).alias(FOLD), "*"
            )

        with ThreadPool(max(1, settings.parallelism)) as pool:
            found = pool.map(inheritable_thread_target(train.sparkSession)(run), list(enumerate(candidate.grid)))
        stacked = found[0]
        for piece in found[1:]:
            stacked = stacked.unionByName(piece)
        pieces.append(materialize(stacked, f"cv-{candidate.name}-{fold}"))
        matrix.unpersist()
    union = pieces[0]
    for piece in pieces[1:]:
        union = union.unionByName(piece)
    return union


def _cross_validate_together(train: DataFrame, candidate: Candidate, settings: ExperimentSettings) -> DataFrame:
    """The same for logistic regressions: each fold is prepared on its own, then all are trained in the same passes."""
    data = settings.dataset
    seen_rows, held_rows = None, []
    for fold in range(settings.folds):
        seen = train.filter(F.col(FOLD) != fold)
        preparation = _prepare(seen, candidate, settings)
        matrix = training_matrix(seen, preparation, candidate, settings).drop("id").withColumn(FOLD, F.lit(fold))
        seen_rows = matrix if seen_rows is None else seen_rows.unionByName(matrix)
        held_rows.append(preparation.transform(train.filter(F.col(FOLD) == fold)))
    models = fit_logistic_grid(
        seen_rows, [_penalty(p) for p in candidate.grid], fold=FOLD, label=LABEL, weight=WEIGHT if candidate.weighted else None
    )
    union = None
    for fold, held in enumerate(held_rows):
        chances = F.posexplode(probabilities(vector_to_array("features"), models[fold])).alias("grid", "probability")
        scored = held.select(F.lit(fold).alias(FOLD), F.col(data.id_column), F.col(data.target).cast("int").alias(data.target), chances)
        scored = scored.select("grid", FOLD, data.id_column, data.target, "probability")
        union = scored if union is None else union.unionByName(scored)
    return materialize(union, f"cv-{candidate.name}")


def grid_scores(predictions: DataFrame, settings: ExperimentSettings) -> DataFrame:
    """Mean fold metrics per parameter set; each fold is rated at its own best threshold."""
    keys, target = ["grid", FOLD], settings.dataset.target
    at_best = best_threshold(predictions, label=target, score="probability", cost=settings.cost, keys=keys)
    at_half = evaluate_threshold(
        predictions, label=target, score="probability", threshold=0.5, cost=settings.cost, keys=keys
    ).select(*keys, "accuracy", "balanced_accuracy")
    joined = at_best.drop("accuracy", "balanced_accuracy").join(at_half, keys)
    metrics = ["business_score", "roc_auc", "average_precision", "accuracy", "balanced_accuracy"]
    return joined.groupBy("grid").agg(
        *[F.avg(m).alias(f"mean_{m}") for m in metrics], F.stddev_pop("business_score").alias("std_business_score")
    )


def evaluate_candidate(
    train: DataFrame, holdout: DataFrame, candidate: Candidate, settings: ExperimentSettings
) -> CandidateOutcome:
    """Select parameters, choose the threshold on out-of-fold scores, check it on the hold-out."""
    data, cost = settings.dataset, settings.cost
    predictions = cross_validate(train, candidate, settings)
    scores = grid_scores(predictions, settings).orderBy("grid").collect()
    best = max(scores, key=lambda r: (r["mean_business_score"], -r["grid"]))
    params = candidate.grid[best["grid"]]

    oof = predictions.filter(F.col("grid") == best["grid"]).drop("grid")
    chosen = best_threshold(oof, label=data.target, score="probability", cost=cost).first()

    preparation = _prepare(train, candidate, settings)
    matrix = training_matrix(train, preparation, candidate, settings).persist(StorageLevel.MEMORY_AND_DISK)
    model = _fit(matrix, candidate, params, settings)
    matrix.unpersist()
    held = materialize(_predictions(holdout, preparation, model, settings), f"holdout-{candidate.name}")
    check = evaluate_threshold(
        held, label=data.target, score="probability", threshold=chosen["threshold"], cost=cost
    ).first()

    result = {
        "model_name": candidate.name,
        "base_model_name": candidate.base_name,
        "sampling_strategy": candidate.sampling,
        "run_id": None,
        "best_params": json.dumps(params),
        "threshold": chosen["threshold"],
        "cv_business_cost": -best["mean_business_score"],
        **{f"cv_{m}": best[f"mean_{m}"] for m in ("roc_auc", "average_precision", "accuracy", "balanced_accuracy")},
        **{f"oof_{m}": chosen[m] for m in (
            "roc_auc", "average_precision", "precision", "recall", "f1", "accuracy", "balanced_accuracy")},
        **{f"holdout_{m}": check[m] for m in (
            "business_cost", "business_score", "roc_auc", "average_precision", "accuracy", "balanced_accuracy",
            "precision", "recall", "f1", "brier_score", "ks_statistic")},
        **{m: check[m] for m in ("true_negatives", "false_positives", "false_negatives", "true_positives")},
    }
    flagged = (F.col("probability") >= chosen["threshold"]).cast("int").alias("prediction")
    spark = train.sparkSession
    cv_results = spark.createDataFrame(
        [(candidate.name, json.dumps(candidate.grid[r["grid"]]), *[float(r[c]) for c in scores[0].asDict() if c != "grid"])
         for r in scores],
        "model_name STRING, params STRING, " + ", ".join(f"{c} DOUBLE" for c in scores[0].asDict() if c != "grid"),
    )
    columns = [data.id_column, data.target, "probability", flagged]
    return CandidateOutcome(
        candidate, params, result, PipelineModel(stages=[*preparation.stages, model]), cv_results,
        oof.select(*columns), held.select(*columns),
    )


def results_table(outcomes: Sequence[CandidateOutcome]) -> DataFrame:
    spark = outcomes[0].oof.sparkSession
    return spark.createDataFrame([o.result for o in outcomes], RESULT_SCHEMA)


def run_experiment(
    df: DataFrame, candidates: Mapping[str, Candidate], settings: ExperimentSettings = ExperimentSettings()
) -> tuple[DataFrame, dict[str, CandidateOutcome], str]:
    """Results table, outcome per candidate and the champion's name."""
    data = settings.dataset
    flagged = stratified_split(
        df, label=data.target, ids=[data.id_column], holdout=data.holdout_fraction, seed=data.seed
    )
    split = materialize(flagged, "split")
    holdout = split.filter("is_holdout").drop("is_holdout")
    folded = stratified_folds(
        split.filter("NOT is_holdout").drop("is_holdout"), label=data.target, ids=[data.id_column],
        k=settings.folds, seed=data.seed, fold=FOLD,
    )
    train = materialize(folded, "folds")
    outcomes = {name: evaluate_candidate(train, holdout, c, settings) for name, c in candidates.items()}
    results = results_table(list(outcomes.values()))
    return results, outcomes, champion(results).first()["model_name"]


def refit(df: DataFrame, candidate: Candidate, params: Mapping, settings: ExperimentSettings) -> PipelineModel:
    """The candidate with fixed parameters, trained on every labelled row."""
    preparation = _prepare(df, candidate, settings)
    matrix = training_matrix(df, preparation, candidate, settings).persist(StorageLevel.MEMORY_AND_DISK)
    model = _fit(matrix, candidate, params, settings)
    matrix.unpersist()
    return PipelineModel(stages=[*preparation.stages, model])


def resolve_champion(
    found: Mapping | None, *, model_name: str, sampling_strategy: str, params: Mapping | None = None,
    threshold: float | None = None,
) -> tuple[dict, float]:
    """Parameters and threshold to serve: explicit values win, recorded ones apply to the same candidate only."""
    same = bool(found) and found["model_name"] == model_name and found["sampling_strategy"] == sampling_strategy
    resolved = {**(found["params"] if same else {}), **(params or {})}
    if threshold is not None:
        return resolved, threshold
    if same:
        return resolved, float(found["threshold"])
    raise ValueError(f"No known business threshold for {model_name}/{sampling_strategy}")
