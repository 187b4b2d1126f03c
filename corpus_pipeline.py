"""The corpus pipeline: quality, near duplicates, benchmark leaks, personal data, and mixing to target shares.

Each stage takes the documents its predecessor kept and returns those it keeps; all but the last return the columns
of the documents. A stage's result is written as Parquet to the shared folder and read again by the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.decontamination import drop_contaminated
from riskloom.llm.mixing import label_domains, weighted
from riskloom.llm.near_dedup import drop_near_duplicates
from riskloom.llm.pii import redact
from riskloom.llm.quality_cnn import drop_low_quality
from riskloom.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level classifier accepts."""
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, spans of personal data replaced by their kind."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a rate above 0, with their rate and whole number of copies in the mixture."""
    return weighted(docs, label_domains(docs, table(spark, sf_dir, "labels")))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixing", mixing),
]

#: A trained network decides in the first stage, so SQL cannot express the rows of run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
