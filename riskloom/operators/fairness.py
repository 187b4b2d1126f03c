"""Group fairness at a decided threshold: per-group rates, disparity and the two-attribute report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import safe_ratio
from riskloom.operators.scorecurve import confusion_counts, cost_expression
from riskloom.settings import CostModel

# ---- Fixed values -----------------------------------------------------------------------------
DISPARATE_IMPACT_LIMIT = 0.8
AGE_BANDS = [(20, 30, "20-29"), (30, 40, "30-39"), (40, 50, "40-49"), (50, 60, "50-59"), (60, 100, "60+")]
# -----------------------------------------------------------------------------------------------


def age_band(age: Column | str) -> Column:
    """Fixed half-open bands; an age outside every band is NULL."""
    value = F.col(age) if isinstance(age, str) else age
    band = None
    for low, high, label in AGE_BANDS:
        inside = (value >= low) & (value < high)
        band = F.when(inside, label) if band is None else band.when(inside, label)
    return band


def enrich_predictions(predictions: DataFrame, attributes: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    """Predictions with their sensitive attributes (inner join on the client key)."""
    return predictions.join(attributes, key)


def lost_predictions(predictions: DataFrame, attributes: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    """Predictions without attributes: the rows the enrichment loses."""
    return predictions.join(attributes.select(key), key, "left_anti")


def fairness_table(
    df: DataFrame,
    *,
    group: str,
    target: str = "TARGET",
    prediction: str = "prediction",
    cost: CostModel = CostModel(),
) -> DataFrame:
    """One row per non-NULL group value."""
    label, decided = F.col(target), F.col(prediction)
    counted = (
        df.filter(F.col(group).isNotNull())
        .groupBy(F.col(group).cast("string").alias("group"))
        .agg(
            F.count("*").alias("n"),
            F.count_if(label == 1).alias("n_positive_target"),
            F.count_if(label == 0).alias("__negatives"),
            F.count_if(decided == 1).alias("__selected"),
            *confusion_counts(label, decided),
        )
    )
    return counted.select(
        "group",
        "n",
        "n_positive_target",
        safe_ratio("__selected", "n").alias("selection_rate"),
        safe_ratio("true_positives", "n_positive_target").alias("recall"),
        safe_ratio("false_positives", "__negatives").alias("fpr"),
        safe_ratio(cost_expression(cost, normalize=False), "n").alias("business_cost"),
    ).orderBy("group")


def disparity_summary(table: DataFrame) -> DataFrame:
    """Smallest over largest selection rate, recall gap and the four-fifths flag."""
    rate, recall = F.col("selection_rate"), F.col("recall")
    comparable = (F.count("*") >= 2) & (F.count(rate) >= 2) & (F.max(rate) > 0)
    ratio = F.when(comparable, F.try_divide(F.min(rate), F.nullif(F.max(rate), F.lit(0.0))))
    return table.agg(
        ratio.alias("disparate_impact_ratio"),
        F.when(F.count(recall) >= 2, F.max(recall) - F.min(recall)).alias("equal_opportunity_difference"),
        F.coalesce(ratio < DISPARATE_IMPACT_LIMIT, F.lit(False)).alias("flag_disparate_impact"),
    )


def fairness_report(
    df: DataFrame,
    *,
    gender: str = "CODE_GENDER",
    age: str = "AGE_YEARS",
    target: str = "TARGET",
    prediction: str = "prediction",
    cost: CostModel = CostModel(),
) -> Mapping[str, DataFrame]:
    """Group tables for gender and age band, and one disparity row for each."""
    banded = df.withColumn("AGE_BAND", age_band(age))
    tables = {
        "gender": fairness_table(banded, group=gender, target=target, prediction=prediction, cost=cost),
        "age_band": fairness_table(banded, group="AGE_BAND", target=target, prediction=prediction, cost=cost),
    }
    summaries = [disparity_summary(t).select(F.lit(name).alias("attribute"), "*") for name, t in tables.items()]
    return {
        "fairness_by_gender": tables["gender"],
        "fairness_by_age_band": tables["age_band"],
        "fairness_summary": summaries[0].unionByName(summaries[1]),
    }
