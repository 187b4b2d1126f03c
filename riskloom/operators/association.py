"""Feature-target association: point-biserial correlation, bias-corrected Cramer's V, signed modality effects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import capitalize_label, nan_to_null, null_if, safe_corr, safe_ratio
from riskloom.operators.cleaning import numeric_columns
from riskloom.operators.profiling import per_column

MISSING_MODALITY = "MISSING"


def _split_columns(df: DataFrame, target: str) -> tuple[list[str], list[str]]:
    numeric = [c for c in numeric_columns(df, booleans=True) if c != target]
    return numeric, [c for c in df.columns if c != target and c not in numeric]


def _crosstab(df: DataFrame, features: Sequence[str], target: Column) -> DataFrame:
    """(feature, x, y, n) for every categorical feature, NULLs included."""
    prepared = df.select(*[F.col(c).cast("string").alias(c) for c in features], target.alias("y"))
    long = prepared.unpivot(["y"], list(features), "feature", "x")
    return long.groupBy("feature", "x", "y").agg(F.count("*").alias("n"))


def _within_level_limit(cells: DataFrame, max_levels: int) -> DataFrame:
    """Keep the features with at most ``max_levels`` distinct non-NULL values."""
    allowed = (
        cells.groupBy("feature")
        .agg(F.count_distinct("x").alias("levels"))
        .filter(F.col("levels") <= max_levels)
        .select("feature")
    )
    return cells.join(allowed, "feature", "left_semi")


def cramers_v(df: DataFrame, features: Sequence[str], target: str, *, max_levels: int = 40) -> DataFrame:
    """Bias-corrected Cramer's V per categorical feature; NULL for a degenerate table.

    chi-square is n * (sum n_ij^2 / (n_i * n_j) - 1), so empty cells need not exist.
    """
    cells = _within_level_limit(_crosstab(df, features, F.col(target).cast("string")), max_levels)
    cells = cells.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    by_x, by_y = Window.partitionBy("feature", "x"), Window.partitionBy("feature", "y")
    table = (
        cells.withColumns({"nx": F.sum("n").over(by_x), "ny": F.sum("n").over(by_y)})
        .groupBy("feature")
        .agg(
            F.sum("n").cast("double").alias("total"),
            F.sum(F.col("n") * F.col("n") / (F.col("nx") * F.col("ny"))).alias("ratio_sum"),
            F.count_distinct("x").alias("rows"),
            F.count_distinct("y").alias("cols"),
        )
        .filter("rows >= 2 AND cols >= 2")
    )
    n1 = F.col("total") - 1
    rows, cols = F.col("rows"), F.col("cols")
    phi2 = F.greatest(
        F.lit(0.0), F.col("ratio_sum") - 1 - safe_ratio((cols - 1) * (rows - 1), n1)
    )
    room = F.least(cols - safe_ratio(F.pow(cols - 1, F.lit(2)), n1), rows - safe_ratio(F.pow(rows - 1, F.lit(2)), n1)) - 1
    return table.select("feature", F.when(room > 0, F.sqrt(safe_ratio(phi2, room))).alias("score"))


def feature_target_associations(df: DataFrame, target: str, *, max_levels: int = 40) -> DataFrame:
    """Strength of association of every feature with a binary target, strongest first."""
    numeric, categorical = _split_columns(df, target)
    clean = nan_to_null(df)
    parts = []
    if numeric:
        scores = per_column(clean, numeric, lambda c: [safe_corr(c, target).alias("score")])
        parts.append(
            scores.select(
                F.col("column").alias("feature"),
                F.lit("numeric").alias("type_feature"),
                F.lit("point_biserial").alias("method"),
                "score",
                F.abs("score").alias("score_abs"),
            )
        )
    if categorical:
        parts.append(
            cramers_v(clean, categorical, target, max_levels=max_levels).select(
                "feature",
                F.lit("categorical").alias("type_feature"),
                F.lit("cramers_v").alias("method"),
                "score",
                F.col("score").alias("score_abs"),
            )
        )
    combined = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return combined.filter(F.col("score_abs").isNotNull()).orderBy(F.desc("score_abs"), "feature")


def signed_associations(
    df: DataFrame, target: str, *, positive_label: int = 1, max_levels: int = 40, min_modal_count: int = 30
) -> DataFrame:
    """Direction of effect: correlation per numeric feature and per modality against the rest."""
    numeric, categorical = _split_columns(df, target)
    clean = nan_to_null(df)
    hit = F.coalesce((F.col(target) == positive_label).cast("int"), F.lit(0))
    parts = []
    if numeric:
        scores = per_column(
            clean.withColumn("__hit", hit),
            numeric,
            lambda c: [safe_corr(c, "__hit").alias("score"), F.count(c).alias("n")],
        )
        parts.append(
            scores.select(
                F.col("column").alias("feature"),
                F.lit(None).cast("string").alias("modality"),
                F.col("column").alias("label"),
                F.lit("numeric").alias("type_feature"),
                F.lit("point_biserial").alias("method"),
                "score",
                F.abs("score").alias("score_abs"),
                "n",
                F.lit(None).cast("double").alias("target_rate_modality"),
                F.lit(None).cast("double").alias("target_rate_rest"),
            )
        )
    if categorical:
        parts.append(_modality_effects(clean, categorical, hit, max_levels, min_modal_count))
    combined = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return combined.filter(F.col("score").isNotNull()).orderBy(F.desc("score_abs"), "feature", "modality")


def _modality_effects(
    df: DataFrame, features: Sequence[str], hit: Column, max_levels: int, min_modal_count: int
) -> DataFrame:
    """Phi coefficient of (value = modality) against the positive label, from counts only."""
    cells = _within_level_limit(_crosstab(df, features, hit), max_levels)
    modalities = cells.groupBy("feature", F.coalesce("x", F.lit(MISSING_MODALITY)).alias("modality")).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("pos")
    )
    whole = Window.partitionBy("feature")
    counted = modalities.withColumns({"rows": F.sum("n").over(whole), "positives": F.sum("pos").over(whole)})
    n, pos, total, positives = (F.col(c).cast("double") for c in ("n", "pos", "rows", "positives"))
    spread = F.sqrt(n * (total - n)) * F.sqrt(positives * (total - positives))
    score = F.try_divide(total * pos - n * positives, null_if(spread, 0.0))
    return counted.filter(F.col("n") >= min_modal_count).select(
        "feature",
        "modality",
        F.concat_ws(" = ", "feature", "modality").alias("label"),
        F.lit("categorical").alias("type_feature"),
        F.lit("modality_vs_rest").alias("method"),
        score.alias("score"),
        F.abs(score).alias("score_abs"),
        "n",
        safe_ratio(pos, n).alias("target_rate_modality"),
        safe_ratio(positives - pos, total - n).alias("target_rate_rest"),
    )


def strongest(associations: DataFrame, top_n: int = 30) -> DataFrame:
    """The ``top_n`` rows of a report, with a readable label."""
    label = "label" if "label" in associations.columns else "feature"
    return (
        associations.withColumn("feature_label", capitalize_label(label))
        .orderBy(F.desc("score_abs"), "feature")
        .limit(top_n)
    )
