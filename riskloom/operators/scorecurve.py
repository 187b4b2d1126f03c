"""Exact score metrics from one distributed score curve.

The curve has one row per distinct score with the positives and negatives strictly below it, so every
confusion count at ``score >= threshold`` is a subtraction, and AUC, average precision and KS are plain
aggregates. Cost is one shuffle of distinct scores, whatever the number of thresholds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import isclose, linspace, safe_ratio, share
from riskloom.operators.ranking import attach, running_totals
from riskloom.settings import CostModel

COUNTS = ["true_negatives", "false_positives", "false_negatives", "true_positives"]
RATES = ["business_cost", "business_score", "precision", "recall", "f1", "accuracy", "balanced_accuracy"]
CONSTANTS = ["roc_auc", "average_precision", "brier_score", "ks_statistic"]
METRICS = [*RATES, *CONSTANTS, *COUNTS]


def confusion_counts(label: Column, prediction: Column) -> list[Column]:
    """TN, FP, FN, TP as aggregates over labelled predictions."""
    return [
        F.count_if((label == actual) & (prediction == predicted)).alias(name)
        for name, (actual, predicted) in zip(COUNTS, [(0, 0), (0, 1), (1, 0), (1, 1)])
    ]


def cost_expression(cost: CostModel, *, normalize: bool = True) -> Column:
    """Business cost from confusion-count columns."""
    total = F.col("false_negatives") * F.lit(cost.fn_cost) + F.col("false_positives") * F.lit(cost.fp_cost)
    return share(total, _count_total()) if normalize else total


def _count_total() -> Column:
    return F.col("true_negatives") + F.col("false_positives") + F.col("false_negatives") + F.col("true_positives")


def rate_columns(cost: CostModel) -> dict[str, Column]:
    """Threshold metrics from confusion-count columns; a rate over nothing is 0."""
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    recall, specificity = safe_ratio(tp, tp + fn), safe_ratio(tn, tn + fp)
    priced = cost_expression(cost)
    return {
        "business_cost": priced,
        "business_score": -priced,
        "precision": share(tp, tp + fp),
        "recall": F.coalesce(recall, F.lit(0.0)),
        "f1": share(2 * tp, 2 * tp + fp + fn),
        "accuracy": share(tp + tn, _count_total()),
        # A class that does not occur has no recall; the mean is over the classes present.
        "balanced_accuracy": F.coalesce((recall + specificity) / 2, recall, specificity),
    }


def business_cost(
    df: DataFrame, *, label: str, prediction: str, cost: CostModel = CostModel(), keys: Sequence[str] = ()
) -> DataFrame:
    counted = df.groupBy(*keys).agg(*confusion_counts(F.col(label), F.col(prediction)))
    return counted.withColumns(
        {"business_cost": cost_expression(cost), "total_cost": cost_expression(cost, normalize=False)}
    )


def score_curve(
    df: DataFrame,
    *,
    label: str,
    score: str,
    keys: Sequence[str] = (),
    grid_size: int = 0,
    extra_thresholds: Sequence[float] = (),
) -> DataFrame:
    """(keys, threshold, pos, neg, pos_before, neg_before, pos_total, neg_total) per candidate threshold.

    Candidates are the observed scores, an even grid on [0, 1] and any extra thresholds.
    """
    actual = F.col(label).cast("int")
    observed = df.select(
        *keys,
        F.col(score).cast("double").alias("threshold"),
        (actual == 1).cast("long").alias("pos"),
        (actual == 0).cast("long").alias("neg"),
    )
    candidates = _candidate_rows(df, keys, grid_size, extra_thresholds)
    if candidates is not None:
        observed = observed.unionByName(candidates)
    return running_totals(
        observed, value="threshold", measures={"pos": F.col("pos"), "neg": F.col("neg")}, keys=keys
    )


def _candidate_rows(
    df: DataFrame, keys: Sequence[str], grid_size: int, extra_thresholds: Sequence[float]
) -> DataFrame | None:
    if not grid_size and not extra_thresholds:
        return None
    points = F.array(*[F.lit(float(t)) for t in extra_thresholds]).cast("array<double>")
    if grid_size:
        grid = F.transform(F.sequence(F.lit(0), F.lit(grid_size - 1)), lambda i: linspace(i, grid_size))
        points = F.concat(grid, points)
    groups = df.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    return groups.select(
        *keys, F.explode(points).alias("threshold"), F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("neg")
    )


def _curve_constants(keys: Sequence[str]) -> list[Column]:
    """AUC, average precision, KS and Brier as aggregates over a curve; NULL where undefined."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    p, n = F.col("pos_total").cast("double"), F.col("neg_total").cast("double")
    tp, fp = p - F.col("pos_before"), n - F.col("neg_before")
    pairs = F.sum(pos * (F.col("neg_before") + 0.5 * neg))
    step = safe_ratio(pos, p) * safe_ratio(tp, tp + fp)
    gap = safe_ratio(tp, p) - safe_ratio(fp, n)
    squared = pos * F.pow(F.col("threshold") - 1, F.lit(2)) + neg * F.pow(F.col("threshold"), F.lit(2))
    return [
        safe_ratio(pairs, F.max(p) * F.max(n)).alias("roc_auc"),
        F.when(F.max(p) > 0, F.sum(step)).alias("average_precision"),
        safe_ratio(F.sum(squared), F.max(p) + F.max(n)).alias("brier_score"),
        F.when(F.max(gap).isNotNull(), F.greatest(F.max(gap), F.lit(0.0))).alias("ks_statistic"),
    ]


def ranking_metrics(df: DataFrame, *, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC (ties count half), average precision, Brier score and KS statistic."""
    curve = score_curve(df, label=label, score=score, keys=keys)
    return curve.groupBy(*keys).agg(*_curve_constants(keys))


def with_counts(curve: DataFrame) -> DataFrame:
    """Confusion counts for the rule ``score >= threshold``."""
    return curve.withColumns(
        {
            "true_negatives": F.col("neg_before"),
            "false_positives": F.col("neg_total") - F.col("neg_before"),
            "false_negatives": F.col("pos_before"),
            "true_positives": F.col("pos_total") - F.col("pos_before"),
        }
    )


def threshold_sweep(
    df: DataFrame,
    *,
    label: str,
    score: str,
    cost: CostModel = CostModel(),
    extra_thresholds: Sequence[float] = (),
    keys: Sequence[str] = (),
) -> DataFrame:
    """All metrics at every candidate threshold."""
    curve = score_curve(
        df, label=label, score=score, keys=keys, grid_size=cost.grid_size, extra_thresholds=extra_thresholds
    )
    constants = curve.groupBy(*keys).agg(*_curve_constants(keys))
    rated = with_counts(curve).withColumns(rate_columns(cost))
    return attach(rated, constants, keys).select(*keys, "threshold", *METRICS)


def best_threshold(
    df: DataFrame, *, label: str, score: str, cost: CostModel = CostModel(), keys: Sequence[str] = ()
) -> DataFrame:
    """Per group the candidate of least cost, then highest recall, then smallest threshold."""
    curve = score_curve(df, label=label, score=score, keys=keys, grid_size=cost.grid_size)
    rated = with_counts(curve).withColumns(rate_columns(cost))
    order = [F.col("business_cost").alias("o1"), (-F.col("recall")).alias("o2"), F.col("threshold")]
    kept = [c for c in METRICS if c not in CONSTANTS]
    best = F.min(F.struct(*order, F.struct(*kept).alias("at"))).alias("__best")
    picked = rated.groupBy(*keys).agg(best, *_curve_constants(keys))
    return picked.select(*keys, F.col("__best.threshold"), *[
        F.col(c) if c in CONSTANTS else F.col(f"__best.at.{c}") for c in METRICS
    ])


def evaluate_threshold(
    df: DataFrame, *, label: str, score: str, threshold: float, cost: CostModel = CostModel(), keys: Sequence[str] = ()
) -> DataFrame:
    """All metrics at one threshold."""
    predicted = (F.col(score) >= F.lit(float(threshold))).cast("int")
    counted = df.groupBy(*keys).agg(*confusion_counts(F.col(label).cast("int"), predicted))
    rated = counted.withColumns(rate_columns(cost)).withColumn("threshold", F.lit(float(threshold)))
    constants = ranking_metrics(df, label=label, score=score, keys=keys)
    return attach(rated, constants, keys).select(*keys, "threshold", *METRICS)


def curve_points(df: DataFrame, *, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """ROC and precision-recall points, one row per distinct score."""
    counted = with_counts(score_curve(df, label=label, score=score, keys=keys))
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    return counted.select(
        *keys,
        "threshold",
        safe_ratio(fp, fp + tn).alias("false_positive_rate"),
        safe_ratio(tp, tp + fn).alias("true_positive_rate"),
        safe_ratio(tp, tp + fp).alias("precision"),
        *COUNTS,
    )


def mark_selected(sweep: DataFrame, selected: float) -> DataFrame:
    return sweep.withColumn("selected_threshold", isclose("threshold", F.lit(float(selected))))


def threshold_selection_summary(
    oof: DataFrame,
    holdout: DataFrame,
    *,
    label: str,
    score: str,
    selected: float,
    model_name: str,
    cost: CostModel = CostModel(),
) -> DataFrame:
    """Cost, recall and precision at the selected threshold and the least cost, for both data sets."""
    stacked = oof.select(F.lit("oof").alias("split"), label, score).unionByName(
        holdout.select(F.lit("holdout").alias("split"), label, score)
    )
    sweep = mark_selected(
        threshold_sweep(stacked, label=label, score=score, cost=cost, extra_thresholds=[selected], keys=["split"]),
        selected,
    )
    chosen = F.struct("threshold", "business_cost", "recall", "precision")

    def at(split: str, metric: str) -> Column:
        first = F.min(F.when((F.col("split") == split) & F.col("selected_threshold"), chosen))
        return first[metric].alias(f"{split}_{metric}_at_selected_threshold")

    def least(split: str) -> Column:
        return F.min(F.when(F.col("split") == split, F.col("business_cost"))).alias(f"{split}_min_business_cost")

    return sweep.agg(
        F.lit(model_name).alias("model_name"),
        F.lit(float(selected)).alias("selected_threshold"),
        F.lit("out_of_fold_business_cost_minimization").alias("selection_basis"),
        F.lit(cost.fn_cost).alias("fn_cost"),
        F.lit(cost.fp_cost).alias("fp_cost"),
        *[at(s, m) for s in ("oof", "holdout") for m in ("business_cost", "recall", "precision")],
        least("oof"),
        least("holdout"),
    )
