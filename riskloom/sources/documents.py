"""JSON documents: run metadata and small report documents as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.payload import json_kind

RUN_METADATA_SCHEMA = """
    campaign_name STRING, created_at STRING,
    best_model STRUCT<model_name: STRING, base_model_name: STRING, sampling_strategy: STRING,
                      threshold: DOUBLE, best_params: MAP<STRING, STRING>>,
    _corrupt_record STRING
"""


def scan_run_metadata(spark: SparkSession, glob: str) -> DataFrame:
    """One row per readable metadata document, with its path; unreadable files are skipped."""
    raw = (
        spark.read.schema(RUN_METADATA_SCHEMA)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .json(glob)
        .select("*", F.col("_metadata.file_path").alias("source_path"))
    )
    return raw.filter("_corrupt_record IS NULL").drop("_corrupt_record")


def latest_champion(runs: DataFrame, campaign_name: str) -> DataFrame:
    """The champion of the newest run of a campaign (ties: last path); empty when there is none."""
    newest = F.max_by(
        F.struct("campaign_name", "best_model", "source_path"),
        F.struct(F.coalesce("created_at", F.lit("")).alias("created_at"), "source_path"),
    )
    matching = runs.filter((F.col("campaign_name") == campaign_name) & F.col("best_model").isNotNull())
    picked = matching.agg(newest.alias("run")).filter("run IS NOT NULL")
    return picked.select(
        F.col("run.best_model.base_model_name").alias("model_name"),
        F.col("run.best_model.model_name").alias("candidate_key"),
        F.col("run.best_model.sampling_strategy").alias("sampling_strategy"),
        F.col("run.best_model.threshold").alias("threshold"),
        F.col("run.best_model.best_params").alias("params"),
        F.col("run.campaign_name").alias("campaign_name"),
        F.col("run.source_path").alias("source_path"),
    )


def latest_by_name(df: DataFrame, *, name: str, order: str, ties: str) -> DataFrame:
    """Newest row per name; one mergeable aggregate, ties broken by ``ties``."""
    rest = [c for c in df.columns if c != name]
    return df.groupBy(name).agg(F.max_by(F.struct(*rest), F.struct(order, ties)).alias("__row")).select(
        name, *[F.col(f"__row.{c}") for c in rest]
    )


def key_values(df: DataFrame, column: str, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON objects as (key, value) rows; nested values are re-serialised."""
    return df.select(*keep, F.explode(F.from_json(column, "map<string,string>")))


def document_rows(spark: SparkSession, path: str) -> DataFrame:
    """A JSON document as rows: object -> (key, value), list of objects -> table, anything else -> (value)."""
    text = spark.read.option("wholetext", True).text(path)
    kind = text.select(json_kind("value").alias("kind")).first()["kind"] or ""
    if kind.startswith("OBJECT"):
        return key_values(text, "value")
    if kind.startswith("ARRAY<OBJECT"):
        return spark.read.option("multiLine", True).json(path)
    if kind.startswith("ARRAY"):
        return text.select(F.explode(F.from_json("value", "array<string>")).alias("value"))
    return text.select(F.trim("value").alias("value"))
