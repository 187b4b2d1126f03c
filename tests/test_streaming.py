from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.sources.logs import read_log
from riskloom.sources.models import ScoringBundle
from riskloom.streaming import monitoring
from riskloom.streaming.scoring import deduplicated, start_scoring

CALLS = "created_at TIMESTAMP, path STRING, status_code INT, latency_ms DOUBLE"


def bundle(spark):
    df = spark.createDataFrame([(float(i), float(i % 5), int(i > 10)) for i in range(20)], "AGE_YEARS DOUBLE, x DOUBLE, label INT")
    model = Pipeline(stages=[VectorAssembler(inputCols=["AGE_YEARS", "x"], outputCol="features"), LogisticRegression(maxIter=5)]).fit(df)
    schema = T.StructType([T.StructField("AGE_YEARS", T.DoubleType(), False), T.StructField("x", T.DoubleType(), False)])
    return ScoringBundle(model, 0.5, schema)


def test_scoring_logs_valid_and_rejected_requests(spark, tmp_path):
    rows = [("a", '{"AGE_YEARS": 30, "x": 1}'), ("b", '{"AGE_YEARS": 30}'), ("c", "junk"), ("d", '{"AGE_YEARS": 5, "x": 1}'),
            ("a", '{"AGE_YEARS": 30, "x": 1}')]
    source = str(tmp_path / "in")
    requests = spark.createDataFrame(rows, "request_id STRING, request_payload STRING").withColumns(
        {"latency_ms": F.lit(3.0), "created_at": F.lit("2024-05-01 10:00:00").cast("timestamp")})
    requests.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(requests.schema).parquet(source)
    root = str(tmp_path / "logs")
    start_scoring(stream, bundle(spark), log_root=root, checkpoint=str(tmp_path / "cp")).awaitTermination()
    calls = {(r["status_code"], r["error_type"]): r for r in read_log(spark, root, "api_call_logs").collect()}
    assert read_log(spark, root, "api_call_logs").count() == 4
    assert set(calls) == {(200, None), (422, "http_422")}
    assert calls[200, None]["request_payload"] is None and calls[422, "http_422"]["request_payload"] is not None
    for table in ("prediction_logs", "production_inputs", "production_outputs"):
        assert read_log(spark, root, table).count() == 1
    assert read_log(spark, root, "production_inputs").first()["feature_count"] == 2


def test_window_kpis_equal_the_batch_result(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(f"2024-01-01 {h:02d}:{m:02d}:00", "/p" if m % 3 else None, 500 if m % 7 == 0 else 200, float(round(rng.exponential(50), 1)))
            for h in range(3) for m in range(60)]
    df = spark.createDataFrame(rows, "created_at STRING, path STRING, status_code INT, latency_ms DOUBLE").withColumn(
        "created_at", F.col("created_at").cast("timestamp"))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    monitoring.start_kpis(stream, lambda: spark.read.parquet(source), path=out, checkpoint=str(tmp_path / "cp")).awaitTermination()
    found = {(r["window_start"].hour, r["path"]): r for r in spark.read.parquet(out).collect()}
    assert set(found) == {(h, p) for h in (0, 1) for p in ("/p", None)}
    batch = {(r["window_start"].hour, r["path"]): r for r in monitoring.window_kpis(monitoring.latency_counts(df), df).collect()}
    for key, row in found.items():
        values = [r[3] for r in rows if int(r[0][11:13]) == key[0] and r[1] == key[1]]
        assert row["total_calls"] == len(values) and abs(row["latency_p95_ms"] - np.quantile(values, 0.95)) < 1e-9
        for name, value in batch[key].asDict().items():  # sums of doubles depend on the order of addition
            assert row[name] == (pytest.approx(value) if isinstance(value, float) else value)


def test_counts_and_deduplication(spark, tmp_path):
    df = spark.createDataFrame([(f"r{i % 4}", "approved" if i % 3 else "refused") for i in range(12)], "request_id STRING, credit_decision STRING")
    df = df.withColumn("created_at", F.lit("2024-01-01").cast("timestamp"))
    source = str(tmp_path / "in")
    df.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    out = str(tmp_path / "counts")
    monitoring.start_counts(stream, "credit_decision", path=out, checkpoint=str(tmp_path / "cp1")).awaitTermination()
    assert {r["credit_decision"]: r["count"] for r in monitoring.latest_counts(spark, out).collect()} == {"approved": 8, "refused": 4}
    query = (deduplicated(stream).writeStream.format("parquet").option("path", str(tmp_path / "once"))
             .option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "once")).count() == 4


def test_latency_buckets_keep_the_order_and_the_state_stays_small(spark, tmp_path):
    values = [-1e9, -3.0, -1e-4, 0.0, 1e-4, 1e-3, 0.5, 1.0, 1.02, 7.5, 1e6, 1e12, None]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE").withColumn("b", monitoring.latency_bucket(F.col("v")))
    buckets = [r["b"] for r in df.collect()]
    assert buckets[:-1] == sorted(buckets[:-1]) and buckets[-1] is None
    assert max(map(abs, buckets[:-1])) == monitoring.BUCKETS

    draw = np.random.default_rng(4)
    latencies = np.exp(draw.normal(3, 2, 20_000))
    rows = [("2024-01-01 00:10:00", "/p", 200, float(v)) for v in latencies] + [("2024-01-01 00:20:00", "/same", 200, 100.0)] * 500
    calls = spark.createDataFrame(rows, "created_at STRING, path STRING, status_code INT, latency_ms DOUBLE")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    calls.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(calls.schema).option("maxFilesPerTrigger", 1).parquet(source)
    running = monitoring.start_window_counts(stream, path=out, checkpoint=str(tmp_path / "cp"))
    running.awaitTermination()
    state = max(p.stateOperators[0].numRowsTotal for p in running.recentProgress if p.stateOperators)
    assert state < 1_300 and len(set(latencies)) > 19_000
    found = {r["path"]: r for r in monitoring.current_kpis(spark, out, spark.read.parquet(source)).collect()}
    for name, q in (("latency_p50_ms", 0.5), ("latency_p95_ms", 0.95), ("latency_p99_ms", 0.99)):
        assert found["/p"][name] == pytest.approx(np.quantile(latencies, q), rel=1e-12) and found["/same"][name] == 100.0
    assert found["/p"]["total_calls"] == 20_000 and found["/p"]["latency_max_ms"] == latencies.max()
    small = monitoring.compact_counts(spark, out, str(tmp_path / "small"))
    again = {r["path"]: r for r in monitoring.current_kpis(spark, small, spark.read.parquet(source)).collect()}
    assert again == found


def test_window_drift_does_not_depend_on_the_trigger(spark, tmp_path):
    draw = np.random.default_rng(9)

    def rows(n, shift, start):
        return [(f"2024-01-{start + i * 5 // n:02d} 12:00:00", float(draw.normal(shift)) if i % 9 else None, "abcd"[int(draw.integers(0, 3 + (shift > 0)))], i % 2 == 0)
                for i in range(n)]

    schema = "created_at STRING, x DOUBLE, s STRING, flag BOOLEAN"
    profile = monitoring.drift_profile(spark.createDataFrame(rows(400, 0.0, 1), schema).drop("created_at"))
    assert {p["feature"] for p in profile} == {"x", "s", "flag"}
    source = tmp_path / "in"
    current = rows(600, 0.8, 10)
    for k in range(10):  # ten files in order of time
        part = spark.createDataFrame(current[60 * k : 60 * k + 60], schema).coalesce(1)
        part.write.mode("append").parquet(str(source))
    typed = spark.read.parquet(str(source)).withColumn("created_at", F.col("created_at").cast("timestamp"))
    batch = monitoring.window_drift(monitoring.drift_counts(typed, profile), profile)

    def plain(df):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()), key=repr)

    want = plain(batch)
    assert len(want) == 15 and {r["drift_level"] for r in batch.collect()} >= {"high"}
    for files in (1, 3, 10):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(str(source))
        out = str(tmp_path / f"out{files}")
        monitoring.start_window_drift(stream, profile, path=out, checkpoint=str(tmp_path / f"cp{files}"), watermark="30 days").awaitTermination()
        assert plain(monitoring.current_drift(spark, out, profile)) == want
    lacking = monitoring.drift_counts(typed.drop("x"), profile)
    assert {r["current_missing_rate"] for r in monitoring.window_drift(lacking, profile).where("feature = 'x'").collect()} == {1.0}
