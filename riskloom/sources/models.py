"""Saved scoring bundles: pipeline, decision threshold, feature schema and metadata in one folder."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from riskloom.operators.validation import RequestField
from riskloom.sources.tables import write_metadata


@dataclass
class ScoringBundle:
    model: PipelineModel
    threshold: float
    schema: T.StructType
    metadata: Mapping = field(default_factory=dict)

    def request_fields(self) -> list[RequestField]:
        """Request contract: nullable columns are optional."""
        return [RequestField(f.name, f.dataType.simpleString(), required=not f.nullable) for f in self.schema]


def save_bundle(spark: SparkSession, bundle: ScoringBundle, path: str) -> str:
    root = path.rstrip("/")
    bundle.model.write().overwrite().save(f"{root}/model")
    document = {
        "threshold": bundle.threshold,
        "schema": json.loads(bundle.schema.json()),
        "metadata": dict(bundle.metadata),
    }
    write_metadata(spark, document, f"{root}/bundle")
    return root


def load_bundle(spark: SparkSession, path: str) -> ScoringBundle:
    root = path.rstrip("/")
    document = json.loads(spark.read.option("wholetext", True).text(f"{root}/bundle").first()["value"])
    return ScoringBundle(
        PipelineModel.load(f"{root}/model"),
        float(document["threshold"]),
        T.StructType.fromJson(document["schema"]),
        document["metadata"],
    )
