"""From probabilities to decisions, in batch and in streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- Fixed values -----------------------------------------------------------------------------
APPROVED, REFUSED = "approved", "refused"
# -----------------------------------------------------------------------------------------------


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def decision_columns(probability: Column | str, threshold: float) -> dict[str, Column]:
    """The four response columns; a probability at the threshold is refused."""
    if not 0.0 <= threshold <= 1.0:
        raise ValueError("threshold must be between 0 and 1")
    p = F.col(probability) if isinstance(probability, str) else probability
    flagged = p >= F.lit(float(threshold))
    return {
        "default_probability": p.cast("double"),
        "business_threshold": F.lit(float(threshold)),
        "predicted_default": F.when(flagged, 1).otherwise(0),
        "credit_decision": F.when(flagged, REFUSED).otherwise(APPROVED),
    }


def decide(df: DataFrame, *, probability: str, threshold: float) -> DataFrame:
    return df.withColumns(decision_columns(probability, threshold))


def score(df: DataFrame, model: PipelineModel | Model, *, keep: Sequence[str], threshold: float) -> DataFrame:
    """Model probabilities and decisions next to the ``keep`` columns."""
    scored = model.transform(df).select(*keep, positive_probability().alias("__p"))
    return scored.select(*keep, *[c.alias(n) for n, c in decision_columns("__p", threshold).items()])


def batch_predictions(df: DataFrame, model: PipelineModel | Model, *, id_column: str, threshold: float) -> DataFrame:
    """Scores for unlabelled clients: id, default_probability, default_prediction."""
    return score(df, model, keep=[id_column], threshold=threshold).select(
        id_column, "default_probability", F.col("predicted_default").alias("default_prediction")
    )


def score_with_function(
    df: DataFrame, predict: Callable, *, keep: Sequence[str], features: Sequence[str], threshold: float
) -> DataFrame:
    """Score with any Python model: ``predict`` maps a pandas frame of features to probabilities.

    Batches stream through Arrow; the function is shipped once per task.
    """
    names = list(features)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema]

    def run(batches):
        for frame in batches:
            out = frame[list(keep)].copy()
            out["__p"] = predict(frame[names])
            yield out

    scored = df.select(*dict.fromkeys([*keep, *names])).mapInPandas(run, ", ".join([*kept, "__p double"]))
    return scored.select(*keep, *[c.alias(n) for n, c in decision_columns("__p", threshold).items()])
