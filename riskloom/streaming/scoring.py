"""Streaming scoring: JSON requests -> validation -> model -> decision -> four log tables.

The four tables of a micro-batch are one commit of the log store, named by the query and the batch: a crash leaves all
of them or none, and a batch replayed after its commit is not written again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from riskloom.operators.decisions import score
from riskloom.operators.oplogs import PREDICT_PATH
from riskloom.operators.validation import ALL_RULES, Rule, parse_requests
from riskloom.sources.logs import api_call_rows, append_logs, prediction_log_rows
from riskloom.sources.models import ScoringBundle

ACCEPTED, REJECTED = 200, 422


def deduplicated(requests: DataFrame, *, watermark: str = "10 minutes", by: str = "created_at") -> DataFrame:
    """Drop repeated request ids that arrive within the watermark."""
    return requests.withWatermark(by, watermark).dropDuplicatesWithinWatermark(["request_id"])


def checked_requests(
    requests: DataFrame, bundle: ScoringBundle, rules: Sequence[Rule] = tuple(ALL_RULES)
) -> DataFrame:
    """Typed request columns with ``violations`` and the status the request earns."""
    parsed = parse_requests(requests, bundle.request_fields(), rules=rules)
    return parsed.withColumn("status_code", F.when(F.size("violations") > 0, REJECTED).otherwise(ACCEPTED))


def log_batch(bundle: ScoringBundle, log_root: str, writer: str = "scoring") -> Callable[[DataFrame, int], None]:
    """foreachBatch handler: valid requests are scored and logged, every request is logged as a call.

    Batches are named by the query's own id, which a new checkpoint changes; ``writer`` serves where there is none.
    """
    keep = ["request_id", "request_payload", "latency_ms", "created_at"]

    def handle(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            accepted = held.filter(F.col("status_code") == ACCEPTED)
            scored = score(accepted, bundle.model, keep=keep, threshold=bundle.threshold)
            calls = held.withColumns(
                {
                    "method": F.lit("POST"),
                    "path": F.lit(PREDICT_PATH),
                    "error_message": F.when(F.size("violations") > 0, F.concat_ws(" ", "violations")),
                }
            )
            query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            rows = {**prediction_log_rows(scored), "api_call_logs": api_call_rows(calls)}
            append_logs(rows, log_root, batch=batch_id, writer=query or writer)
        finally:
            held.unpersist()

    return handle


def start_scoring(
    requests: DataFrame, bundle: ScoringBundle, *, log_root: str, checkpoint: str, rules: Sequence[Rule] = tuple(ALL_RULES),
    **trigger,
) -> StreamingQuery:
    """``requests``: request_id, request_payload, latency_ms, created_at."""
    stream = checked_requests(deduplicated(requests), bundle, rules)
    return (
        stream.writeStream.foreachBatch(log_batch(bundle, log_root))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
