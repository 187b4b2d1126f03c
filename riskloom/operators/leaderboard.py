"""Candidate comparison: ranking and the report views over one row per candidate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import f_beta, slugify

# ---- Fixed values: result columns and report layouts --------------------------------------------
RESULT_SCHEMA = """
    model_name STRING, base_model_name STRING, sampling_strategy STRING, run_id STRING,
    best_params STRING, threshold DOUBLE,
    cv_business_cost DOUBLE, cv_roc_auc DOUBLE, cv_average_precision DOUBLE, cv_accuracy DOUBLE,
    cv_balanced_accuracy DOUBLE,
    oof_roc_auc DOUBLE, oof_average_precision DOUBLE, oof_precision DOUBLE, oof_recall DOUBLE,
    oof_f1 DOUBLE, oof_accuracy DOUBLE, oof_balanced_accuracy DOUBLE,
    holdout_business_cost DOUBLE, holdout_business_score DOUBLE, holdout_roc_auc DOUBLE,
    holdout_average_precision DOUBLE, holdout_accuracy DOUBLE, holdout_balanced_accuracy DOUBLE,
    holdout_precision DOUBLE, holdout_recall DOUBLE, holdout_f1 DOUBLE, holdout_brier_score DOUBLE,
    holdout_ks_statistic DOUBLE,
    true_negatives BIGINT, false_positives BIGINT, false_negatives BIGINT, true_positives BIGINT
"""
IDENTITY = ["selected_as_best", "model", "base_model", "sampling"]
CV_VIEW = [
    *IDENTITY,
    "threshold", "cv_business_cost", "cv_roc_auc", "cv_average_precision", "cv_accuracy",
    "cv_balanced_accuracy", "oof_roc_auc", "oof_average_precision", "oof_precision", "oof_recall", "oof_f1",
    "oof_accuracy", "oof_balanced_accuracy", "best_params", "run_id",
]
HOLDOUT_VIEW = [
    *IDENTITY,
    "threshold", "holdout_business_cost", "holdout_business_score", "holdout_roc_auc",
    "holdout_average_precision", "holdout_accuracy", "holdout_balanced_accuracy", "holdout_precision",
    "holdout_recall", "holdout_f1", "holdout_brier_score", "holdout_ks_statistic", "true_negatives",
    "false_positives", "false_negatives", "true_positives", "best_params", "run_id",
]
THRESHOLD_VIEW = [
    *IDENTITY,
    "selection_basis", "threshold", "holdout_business_cost", "holdout_business_score", "holdout_precision",
    "holdout_recall", "holdout_f1", "true_negatives", "false_positives", "false_negatives", "true_positives",
    "run_id",
]
PERFORMANCE_VIEW = [
    "rank", "selected_as_best", "model", "base_model", "sampling", "family", "estimator_class",
    "strategie_seuil", "threshold", "precision_1", "recall_1", "f1_1", "f2_1", "prc_auc", "train_precision_1",
    "train_recall_1", "train_f1_1", "train_f2_1", "train_prc_auc", "holdout_business_cost",
    "holdout_business_score", "cv_business_cost", "cv_roc_auc", "cv_average_precision", "tn", "fp", "fn", "tp",
    "best_params", "run_id",
]
SELECTION_BASIS = "out_of_fold_business_cost_minimization"
# -----------------------------------------------------------------------------------------------

RANKING = [F.asc, F.desc, F.desc]
RANKED_BY = ["cv_business_cost", "cv_average_precision", "cv_roc_auc"]


def _ranking() -> list[Column]:
    return [direction(column) for direction, column in zip(RANKING, RANKED_BY)]


def ranked(results: DataFrame) -> DataFrame:
    """Candidates with their 1-based rank; the table has one row per candidate."""
    return results.withColumn("rank", F.row_number().over(Window.orderBy(*_ranking(), F.asc("model_name"))))


def champion(results: DataFrame) -> DataFrame:
    return results.orderBy(*_ranking(), "model_name").limit(1)


def _identified(results: DataFrame) -> DataFrame:
    return ranked(results).withColumns(
        {
            "selected_as_best": F.col("rank") == 1,
            "model": F.col("model_name"),
            "base_model": F.col("base_model_name"),
            "sampling": F.col("sampling_strategy"),
            "selection_basis": F.lit(SELECTION_BASIS),
        }
    )


def cv_view(results: DataFrame) -> DataFrame:
    return _identified(results).orderBy("rank").select(*CV_VIEW)


def holdout_view(results: DataFrame) -> DataFrame:
    return _identified(results).orderBy("rank").select(*HOLDOUT_VIEW)


def threshold_view(results: DataFrame) -> DataFrame:
    return _identified(results).orderBy("rank").select(*THRESHOLD_VIEW)


def family(estimator_class: Column | str) -> Column:
    name = F.col(estimator_class) if isinstance(estimator_class, str) else estimator_class
    return (
        F.when(name.contains("LogisticRegression"), "linear")
        .when(name.contains("Forest") | name.contains("Trees"), "bagging_tree")
        .when(name.contains("GBT") | name.contains("LGBM") | name.contains("Boost"), "boosting_tree")
        .otherwise("other")
    )


def performance_view(results: DataFrame, estimator_classes: Mapping[str, str]) -> DataFrame:
    """Scores on the positive class, F2 included; ``estimator_classes`` maps base model to class name."""
    lookup = F.create_map(*[F.lit(x) for pair in estimator_classes.items() for x in pair])
    named = _identified(results).withColumn("estimator_class", F.try_element_at(lookup, F.col("base_model_name")))
    renamed = {
        "precision_1": "holdout_precision", "recall_1": "holdout_recall", "f1_1": "holdout_f1",
        "prc_auc": "holdout_average_precision", "train_precision_1": "oof_precision",
        "train_recall_1": "oof_recall", "train_f1_1": "oof_f1", "train_prc_auc": "oof_average_precision",
        "tn": "true_negatives", "fp": "false_positives", "fn": "false_negatives", "tp": "true_positives",
    }
    return (
        named.withColumns({new: F.col(old) for new, old in renamed.items()})
        .withColumns(
            {
                "family": family("estimator_class"),
                "strategie_seuil": F.lit("cv_business_cost_optimized"),
                "f2_1": f_beta("holdout_precision", "holdout_recall"),
                "train_f2_1": f_beta("oof_precision", "oof_recall"),
            }
        )
        .orderBy("rank")
        .select(*PERFORMANCE_VIEW)
    )


def best_model_view(performance: DataFrame) -> DataFrame:
    return performance.filter("selected_as_best")


def runs_view(results: DataFrame, *, campaign_name: str, root_run_id: str | None = None) -> DataFrame:
    """One row for the campaign and one per candidate."""
    models = _identified(results).select(
        F.lit("model").alias("scope"),
        F.lit(campaign_name).alias("campaign_name"),
        "model", "base_model", "sampling",
        F.coalesce("run_id", F.lit("")).alias("run_id"),
        "selected_as_best", "threshold", "holdout_business_cost", "holdout_roc_auc",
    )
    head = results.sparkSession.range(1).select(
        F.lit("campaign").alias("scope"),
        F.lit(campaign_name).alias("campaign_name"),
        *[F.lit("").alias(c) for c in ("model", "base_model", "sampling")],
        F.lit(root_run_id or "").alias("run_id"),
        F.lit(False).alias("selected_as_best"),
        *[F.lit(None).cast("double").alias(c) for c in ("threshold", "holdout_business_cost", "holdout_roc_auc")],
    )
    return head.unionByName(models)


def campaign_overview(
    df: DataFrame, *, campaign_name: str, target: str, facts: Mapping[str, object], split: str | None = None
) -> DataFrame:
    """One row of campaign facts plus row counts and target rate of the training table."""
    held_out = F.col(split) if split else F.lit(False)
    counted = df.agg(
        F.count("*").alias("sampled_rows"),
        F.count_if(~held_out).alias("train_rows"),
        F.count_if(held_out).alias("holdout_rows"),
        F.avg(F.col(target).cast("double")).alias("target_rate"),
    )
    return counted.select(
        F.lit(campaign_name).alias("campaign_name"),
        slugify(F.lit(campaign_name)).alias("campaign_slug"),
        *[F.lit(value).alias(name) for name, value in facts.items()],
        F.lit(len(df.columns)).alias("sampled_columns"),
        "*",
    )
