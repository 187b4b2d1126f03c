"""Model explanations as long tables: importances, linear and permutation Shapley values, roll-ups.

A long explanation table has one row per (client, transformed feature) with ``shap_value``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions import hash_order
from riskloom.operators.decisions import positive_probability
from riskloom.operators.sampling import random_sample

NUMERIC_SUFFIX, ONE_HOT_SUFFIX = "__num", "__oh"


def feature_names(transformed: DataFrame, vector: str = "assembled") -> list[str]:
    """Slot names of an assembled vector column, from its attribute metadata."""
    groups = transformed.schema[vector].metadata["ml_attr"]["attrs"]
    slots = {a["idx"]: a["name"] for group in groups.values() for a in group}
    return [slots[i] for i in sorted(slots)]


def source_of(name: str) -> tuple[str, str]:
    """(source feature, kind) of a transformed feature."""
    if name.endswith(NUMERIC_SUFFIX):
        return name.removesuffix(NUMERIC_SUFFIX), "numeric"
    if f"{ONE_HOT_SUFFIX}_" in name:
        return name.rsplit(f"{ONE_HOT_SUFFIX}_", 1)[0], "categorical"
    return name, "unknown"


def feature_mapping(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """One row per vector slot: position, transformed feature, source feature, kind."""
    rows = [(i, name, *source_of(name)) for i, name in enumerate(names)]
    return spark.createDataFrame(
        rows, "position INT, transformed_feature STRING, source_feature STRING, feature_kind STRING"
    )


def native_importance(model: Model) -> list[float] | None:
    """Tree importances or absolute coefficients; None for a model without either."""
    if hasattr(model, "featureImportances"):
        return [float(x) for x in model.featureImportances.toArray()]
    if hasattr(model, "coefficients"):
        return [abs(float(x)) for x in model.coefficients.toArray()]
    return None


def importance_table(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    """Importance per transformed feature; empty for models without native importance."""
    values = native_importance(model)
    schema = "position INT, importance DOUBLE"
    rows = [] if values is None else list(enumerate(values))
    return (
        feature_mapping(spark, names)
        .join(spark.createDataFrame(rows, schema), "position")
        .drop("position")
        .orderBy(F.desc("importance"), "transformed_feature")
    )


def importance_by_source(importances: DataFrame) -> DataFrame:
    return (
        importances.groupBy("source_feature", "feature_kind")
        .agg(F.sum("importance").alias("importance"))
        .orderBy(F.desc("importance"), "source_feature")
    )


def linear_shap(
    df: DataFrame, *, id_column: str, vector: str, coefficients: Sequence[float], names: Sequence[str],
    background: DataFrame | None = None,
) -> DataFrame:
    """coefficient x (value - background mean) per client and feature, on the margin scale."""
    spark = df.sparkSession
    centre = (background if background is not None else df).agg(Summarizer.mean(F.col(vector)).alias("m"))
    means = centre.select(F.posexplode(vector_to_array("m")).alias("position", "mean"))
    weights = spark.createDataFrame(
        [(i, float(c)) for i, c in enumerate(coefficients)], "position INT, coefficient DOUBLE"
    )
    # One row per vector slot: as wide as the model, independent of the data.
    slots = feature_mapping(spark, names).join(weights, "position").join(means, "position")
    long = df.select(
        F.col(id_column).alias("client_id"),
        F.posexplode(vector_to_array(vector)).alias("position", "feature_value"),
    )
    joined = long.join(F.broadcast(slots), "position")
    return joined.select(
        "client_id", "transformed_feature", "source_feature", "feature_kind", "feature_value",
        (F.col("coefficient") * (F.col("feature_value") - F.col("mean"))).alias("shap_value"),
    )


def permutation_shap(
    sample: DataFrame, model: Model, *, id_column: str, vector: str, names: Sequence[str],
    background: DataFrame, background_rows: int = 100, permutations: int = 4, seed: int = 42,
) -> DataFrame:
    """Sampled Shapley values for any model, for a sample of clients.

    Every (client, draw) walks one random feature order from the background to the client's row; the model's answer
    at a step is its mean over all ``background_rows`` rows (all of ``background``, if it has fewer), and a feature's
    value is the mean change when it is switched. Values of a client add up to its probability minus ``base_value``,
    the mean probability of the background, which is the same for all clients. ``permutations`` is the number of
    walks a client.
    """
    spark, width = sample.sparkSession, len(names)
    base = random_sample(background, background_rows, ids=[id_column], seed=seed)
    numbered = base.select(
        (F.row_number().over(Window.orderBy(hash_order(id_column, seed=seed), id_column)) - 1).alias("slot"),
        vector_to_array(vector).alias("base"),
    )
    backgrounds = numbered.count()
    walks = sample.select(
        F.col(id_column).alias("client_id"),
        vector_to_array(vector).alias("own"),
        F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))).alias("draw"),
    )
    order = F.array_sort(
        F.transform(
            F.sequence(F.lit(0), F.lit(width - 1)),
            lambda i: F.struct(F.xxhash64(F.col("client_id"), F.col("draw"), i, F.lit(seed)).alias("h"), i.alias("i")),
        )
    )
    walks = walks.withColumn("order", F.transform(order, lambda s: s["i"]))
    # turn[i] is the step at which feature i is switched: the inverse of ``order``.
    turns = F.array_sort(F.transform("order", lambda i, at: F.struct(i.alias("i"), at.alias("at"))))
    walks = walks.withColumn("turn", F.transform(turns, lambda s: s["at"]))
    steps = walks.select("*", F.explode(F.sequence(F.lit(0), F.lit(width))).alias("step"))
    # every step meets every background row: at most background_rows rows, sent to every task
    steps = steps.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(backgrounds - 1)))).join(F.broadcast(numbered), "slot")
    mixed = F.transform(
        "turn", lambda at, i: F.when(at < F.col("step"), F.get("own", i)).otherwise(F.get("base", i))
    )
    probes = steps.select(
        "client_id", "draw", "step", F.get("order", F.col("step") - 1).alias("position"),
        F.get("own", F.get("order", F.col("step") - 1)).alias("feature_value"),
        array_to_vector(mixed).alias(model.getFeaturesCol()),
    )
    scored = model.transform(probes).withColumn("p", positive_probability())
    scored = scored.groupBy("client_id", "draw", "step", "position").agg(F.avg("p").alias("p"), F.first("feature_value").alias("feature_value"))
    start = F.first("p").over(Window.partitionBy("client_id", "draw").orderBy("step"))
    scored = scored.withColumn("start", start)
    before = F.lag("p").over(Window.partitionBy("client_id", "draw").orderBy("step"))
    changes = scored.withColumn("change", F.col("p") - before).filter("step > 0")
    values = changes.groupBy("client_id", "position").agg(
        F.avg("change").alias("shap_value"), F.max("feature_value").alias("feature_value"), F.avg("start").alias("base_value")
    )
    return values.join(F.broadcast(feature_mapping(spark, names)), "position").select(
        "client_id", "transformed_feature", "source_feature", "feature_kind", "feature_value", "shap_value", "base_value"
    )


def global_shap(explanations: DataFrame) -> DataFrame:
    """Mean absolute value per transformed feature."""
    return (
        explanations.groupBy("transformed_feature", "source_feature", "feature_kind")
        .agg(F.avg(F.abs("shap_value")).alias("mean_abs_shap"))
        .orderBy(F.desc("mean_abs_shap"), "transformed_feature")
    )


def global_shap_by_source(explanations: DataFrame) -> DataFrame:
    return (
        global_shap(explanations)
        .groupBy("source_feature", "feature_kind")
        .agg(F.sum("mean_abs_shap").alias("mean_abs_shap"))
        .orderBy(F.desc("mean_abs_shap"), "source_feature")
    )


def extreme_clients(scored: DataFrame, n: int, *, id_column: str, probability: str) -> DataFrame:
    """The n riskiest and n safest clients, each client once."""
    top = scored.orderBy(F.desc(probability), id_column).limit(n)
    low = scored.orderBy(F.asc(probability), id_column).limit(n)
    return top.unionByName(low).dropDuplicates([id_column])


def local_shap(explanations: DataFrame, clients: DataFrame, *, top: int = 20, by_source: bool = False) -> DataFrame:
    """The ``top`` strongest contributions of each selected client (client_id, predicted_probability)."""
    chosen = explanations.join(clients.select("client_id", "predicted_probability"), "client_id")
    if by_source:
        valued = chosen.groupBy("client_id", "predicted_probability", "source_feature").agg(
            F.sum("shap_value").alias("shap_value"), F.sum(F.abs("shap_value")).alias("abs_shap")
        )
        tie = "source_feature"
    else:
        valued, tie = chosen.withColumn("abs_shap", F.abs("shap_value")), "transformed_feature"
    strongest = Window.partitionBy("client_id").orderBy(F.desc("abs_shap"), tie)
    return valued.withColumn("place", F.row_number().over(strongest)).filter(F.col("place") <= top)
