"""Operational KPIs over the production logs: calls, latency, decisions, alerts, bottlenecks, integrity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import number, share
from riskloom.operators.profiling import with_share
from riskloom.operators.ranking import attach, exact_quantiles

# ---- Fixed values -----------------------------------------------------------------------------
PREDICT_PATH = "/predict"
FIRST_ERROR_STATUS = 400
MODEL_SHARE_LIMIT = 0.70
ALERT_MESSAGES = {
    "error_rate": "Le taux d'erreur HTTP dépasse le seuil de vigilance.",
    "latency_p95_ms": "La latence p95 dépasse le seuil de vigilance.",
}
BOTTLENECKS = {
    "latency_high": (
        "Latence API p95 élevée", "high",
        "Profiler le endpoint /predict et surveiller CPU/RAM du conteneur.",
    ),
    "latency_low": ("Latence API", "low", "Configuration acceptable sur les seuils actuels."),
    "errors": (
        "Taux d'erreur HTTP", "high",
        "Distinguer erreurs de validation attendues et erreurs serveur.",
    ),
    "model": (
        "Inférence modèle", "moderate",
        "Étudier batching, simplification du preprocessing ou conversion ONNX.",
    ),
    "overhead": (
        "Overhead API / sérialisation / logs", "moderate",
        "Conserver les logs en tâche de fond et éviter les payloads dupliqués.",
    ),
}
# -----------------------------------------------------------------------------------------------

LATENCY_QUANTILES = {"latency_p50_ms": 0.50, "latency_p95_ms": 0.95, "latency_p99_ms": 0.99}


def _or_zero(column: Column | str) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(0.0))


def percentiles(
    df: DataFrame, column: str, quantiles: Mapping[str, float], keys: Sequence[str] = ()
) -> DataFrame:
    """Exact percentiles, 0.0 for an empty column."""
    values = df.select(*keys, number(column).alias("__value"))
    found = exact_quantiles(values, value="__value", quantiles=quantiles, keys=keys)
    return found.select(*keys, *[_or_zero(name).alias(name) for name in quantiles])


def api_call_summary(calls: DataFrame) -> DataFrame:
    """One row of call, error and latency figures; zeros for an empty log."""
    latency, failed = number("latency_ms"), F.col("status_code").cast("int") >= FIRST_ERROR_STATUS
    stamp = F.col("created_at") if "created_at" in calls.columns else F.lit(None).cast("timestamp")
    on_predict = F.col("path") == PREDICT_PATH if "path" in calls.columns else F.lit(False)
    base = calls.agg(
        F.count("*").alias("total_calls"),
        F.count_if(on_predict).alias("predict_calls"),
        F.count_if(failed).alias("error_calls"),
        share(F.count_if(failed), F.count("*")).alias("error_rate"),
        _or_zero(F.avg(latency)).alias("latency_mean_ms"),
        _or_zero(F.max(latency)).alias("latency_max_ms"),
        F.min(stamp).alias("first_call_at"),
        F.max(stamp).alias("last_call_at"),
    )
    return attach(base, percentiles(calls, "latency_ms", LATENCY_QUANTILES), []).select(
        "total_calls", "predict_calls", "error_calls", "error_rate", "latency_mean_ms",
        *LATENCY_QUANTILES, "latency_max_ms", "first_call_at", "last_call_at",
    )


def status_code_summary(calls: DataFrame) -> DataFrame:
    counts = calls.groupBy(F.col("status_code").cast("int").alias("status_code")).agg(F.count("*").alias("count"))
    return with_share(counts, "rate").orderBy("status_code")


def latency_by_path(calls: DataFrame) -> DataFrame:
    """Latency per path, slowest p95 first; a NULL path is a group of its own."""
    timed = calls.select("path", number("latency_ms").alias("latency_ms"))
    base = timed.groupBy("path").agg(
        F.count("latency_ms").alias("count"),
        F.avg("latency_ms").alias("latency_mean_ms"),
        F.max("latency_ms").alias("latency_max_ms"),
    )
    tail = exact_quantiles(timed, value="latency_ms", keys=["path"], quantiles={"latency_p95_ms": 0.95})
    other = tail.withColumnRenamed("path", "__path")
    joined = base.join(other, F.col("path").eqNullSafe(F.col("__path")), "left")
    return joined.select("path", "count", "latency_mean_ms", "latency_p95_ms", "latency_max_ms").orderBy(
        F.desc("latency_p95_ms"), "path"
    )


def prediction_summary(predictions: DataFrame) -> DataFrame:
    refused, approved = (F.count_if(F.col("credit_decision") == d) for d in ("refused", "approved"))
    base = predictions.agg(
        F.count("*").alias("prediction_count"),
        _or_zero(F.avg(number("default_probability"))).alias("default_probability_mean"),
        refused.alias("refused_count"),
        approved.alias("approved_count"),
        share(refused, F.count("*")).alias("refused_rate"),
        share(approved, F.count("*")).alias("approved_rate"),
    )
    spots = {"default_probability_p50": 0.50, "default_probability_p95": 0.95}
    return attach(base, percentiles(predictions, "default_probability", spots), []).select(
        "prediction_count", "default_probability_mean", *spots,
        "refused_count", "approved_count", "refused_rate", "approved_rate",
    )


def operational_alerts(summary: DataFrame, *, latency_warning_ms: float, error_rate_warning: float) -> DataFrame:
    """One row per figure strictly above its limit."""

    def alert(metric: str, limit: float) -> Column:
        row = F.struct(
            F.lit("warning").alias("severity"),
            F.lit(metric).alias("metric"),
            F.col(metric).alias("observed_value"),
            F.lit(float(limit)).alias("threshold"),
            F.lit(ALERT_MESSAGES[metric]).alias("message"),
        )
        return F.when(F.col(metric) > limit, row)

    alerts = F.array(alert("error_rate", error_rate_warning), alert("latency_p95_ms", latency_warning_ms))
    return summary.select(F.inline(F.filter(alerts, lambda a: a.isNotNull())))


def _count_map(df: DataFrame, key: str) -> DataFrame:
    counts = df.groupBy(F.col(key).cast("string").alias("k")).agg(F.count("*").alias("n")).filter("k IS NOT NULL")
    entries = F.sort_array(F.collect_list(F.struct("k", "n")))
    return counts.agg(F.map_from_entries(entries).alias(f"{key}_counts"))


def monitoring_summary(calls: DataFrame, predictions: DataFrame) -> DataFrame:
    """Call and decision figures in one row, with counts per status code and per decision as maps."""
    api = api_call_summary(calls).select(
        F.col("total_calls").alias("total_api_calls"), "predict_calls", "error_calls", "error_rate",
        "latency_mean_ms", "latency_p95_ms",
    )
    decided = prediction_summary(predictions).select(
        "prediction_count", "refused_count", "approved_count", "refused_rate", "approved_rate"
    )
    merged = attach(attach(api, decided, []), _count_map(calls, "status_code"), [])
    decisions = _count_map(predictions, "credit_decision").withColumnRenamed("credit_decision_counts", "decision_counts")
    return attach(merged, decisions, [])


def latency_summary(df: DataFrame, *, source: str, column: str = "latency_ms") -> DataFrame:
    value = number(column)
    base = df.agg(
        F.lit(source).alias("source"),
        F.count(value).alias("count"),
        _or_zero(F.avg(value)).alias("latency_mean_ms"),
        _or_zero(F.max(value)).alias("latency_max_ms"),
    )
    return attach(base, percentiles(df, column, LATENCY_QUANTILES), []).select(
        "source", "count", "latency_mean_ms", *LATENCY_QUANTILES, "latency_max_ms"
    )


def measurement_summary(df: DataFrame, *, success: str = "success", column: str = "client_latency_ms") -> DataFrame:
    """Client-side measurements: successes, errors and latency."""
    value, good = number(column), F.coalesce(F.col(success).cast("boolean"), F.lit(False))
    spots = {f"client_latency_p{p}_ms": p / 100 for p in (50, 95, 99)}
    base = df.agg(
        F.count("*").alias("request_count"),
        F.count_if(good).alias("success_count"),
        F.count_if(~good).alias("error_count"),
        _or_zero(F.avg(value)).alias("client_latency_mean_ms"),
        _or_zero(F.max(value)).alias("client_latency_max_ms"),
    )
    return attach(base, percentiles(df, column, spots), []).select(
        "request_count", "success_count", "error_count", "client_latency_mean_ms", *spots, "client_latency_max_ms"
    )


def bottlenecks(
    api: DataFrame, model: DataFrame, *, latency_warning_ms: float, error_rate_warning: float
) -> DataFrame:
    """Findings from the API summary and the model latency summary (one row each)."""
    model_tail = model.select(F.col("latency_p95_ms").alias("model_p95"))
    both = attach(api.select(F.col("latency_p95_ms").alias("api_p95"), "error_rate"), model_tail, [])
    api_p95, model_p95, error_rate = F.col("api_p95"), F.col("model_p95"), F.col("error_rate")

    def finding(name: str, evidence: Column) -> Column:
        title, severity, advice = BOTTLENECKS[name]
        return F.struct(
            F.lit(title).alias("bottleneck"),
            F.lit(severity).alias("severity"),
            evidence.alias("evidence"),
            F.lit(advice).alias("recommendation"),
        )

    slow = F.format_string(f"p95 API = %.1f ms > seuil {latency_warning_ms:.1f} ms", api_p95)
    calm = F.format_string("p95 API = %.1f ms", api_p95)
    split = F.format_string("p95 modèle = %.1f ms pour p95 API = %.1f ms", model_p95, api_p95)
    failing = F.format_string("taux d'erreur = %.1f%%", error_rate * 100)
    found = F.array(
        F.when(api_p95 > latency_warning_ms, finding("latency_high", slow)).otherwise(finding("latency_low", calm)),
        F.when(error_rate > error_rate_warning, finding("errors", failing)),
        F.when(
            api_p95 != 0,
            F.when(share(model_p95, api_p95) >= MODEL_SHARE_LIMIT, finding("model", split)).otherwise(
                finding("overhead", split)
            ),
        ),
    )
    return both.select(F.inline(F.filter(found, lambda row: row.isNotNull())))


def fk_violations(
    child: DataFrame, parent: DataFrame, *, child_key: str = "prediction_log_id", parent_key: str = "id"
) -> DataFrame:
    """Child rows without a parent and keys referenced more than once.

    References are counted first, so a hot key is one row in the join.
    """
    references = child.groupBy(child_key).agg(F.count("*").alias("rows"))
    orphans = references.join(parent, references[child_key] == parent[parent_key], "left_anti")
    return orphans.select(F.lit("orphan").alias("violation"), child_key, "rows").unionByName(
        references.filter("rows > 1").select(F.lit("repeated_reference").alias("violation"), child_key, "rows")
    )


def latest_rows(df: DataFrame, n: int, *, by: str = "created_at", ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.desc(by), *ties).limit(n)
