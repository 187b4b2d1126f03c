"""Production report: KPIs, alerts and drift over the stored logs; performance report; fairness report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators.cleaning import align_columns, drop_non_features
from riskloom.operators.drift import (
    all_drift,
    categorical_drift,
    drift_summary,
    histogram,
    numeric_drift,
    strongest_drift,
)
from riskloom.operators.fairness import enrich_predictions, fairness_report
from riskloom.operators.oplogs import (
    api_call_summary,
    bottlenecks,
    latency_by_path,
    latency_summary,
    operational_alerts,
    prediction_summary,
    status_code_summary,
)
from riskloom.settings import CostModel, MonitoringSettings
from riskloom.sources.logs import load_api_call_logs, load_production_inputs, load_production_outputs


def drift_tables(reference: DataFrame, current: DataFrame, settings: MonitoringSettings) -> dict[str, DataFrame]:
    expected, observed = align_columns(drop_non_features(reference), current)
    numeric = numeric_drift(expected, observed, settings=settings.drift)
    categorical = categorical_drift(expected, observed, settings=settings.drift)
    everything = all_drift(numeric, categorical)
    return {
        "numeric_drift": numeric,
        "categorical_drift": categorical,
        "drift_summary": drift_summary(everything),
        "top_drift": strongest_drift(everything),
    }


def production_report(
    spark: SparkSession, log_root: str, reference: DataFrame, settings: MonitoringSettings = MonitoringSettings()
) -> dict[str, DataFrame]:
    """All monitoring tables, by name. Nothing runs until a table is written."""
    calls = load_api_call_logs(spark, log_root)
    inputs = load_production_inputs(spark, log_root, drop_non_features(reference).schema)
    outputs = load_production_outputs(spark, log_root)
    api = api_call_summary(calls)
    return {
        "api_summary": api,
        "status_codes": status_code_summary(calls),
        "latency_by_path": latency_by_path(calls),
        "prediction_summary": prediction_summary(outputs),
        "alerts": operational_alerts(
            api, latency_warning_ms=settings.latency_warning_ms, error_rate_warning=settings.error_rate_warning
        ),
        "score_histogram": histogram(outputs, "default_probability"),
        "latency_histogram": histogram(calls, "latency_ms"),
        **drift_tables(reference, inputs, settings),
    }


def performance_report(
    spark: SparkSession, log_root: str, settings: MonitoringSettings = MonitoringSettings()
) -> dict[str, DataFrame]:
    calls, outputs = load_api_call_logs(spark, log_root), load_production_outputs(spark, log_root)
    api, model = api_call_summary(calls), latency_summary(outputs, source="model")
    return {
        "api_summary": api,
        "latency_by_path": latency_by_path(calls),
        "model_latency": model,
        "bottlenecks": bottlenecks(
            api, model, latency_warning_ms=settings.latency_warning_ms, error_rate_warning=settings.error_rate_warning
        ),
    }


def champion_fairness(
    predictions: DataFrame, attributes: DataFrame, *, key: str = "SK_ID_CURR", cost: CostModel = CostModel(),
    **columns: str,
) -> Mapping[str, DataFrame]:
    return fairness_report(enrich_predictions(predictions, attributes, key), cost=cost, **columns)
