from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from riskloom.plans.dataset import build_dataset, quality_reports, save_dataset
from riskloom.sources import logs
from riskloom.sources.documents import document_rows, latest_champion, scan_run_metadata
from riskloom.sources.tables import (
    drop_exact_duplicates,
    duplicate_count,
    file_inventory,
    load_raw,
    read_table,
    write_json_lines,
    write_metadata,
    write_table,
)
from tests.conftest import records


def test_exact_duplicates(frame):
    df = frame([(1, 10, 5.0), (1, 10, 5.0), (1, 11, 5.0), (2, 12, None)], "SK_ID_CURR LONG, SK_ID_PREV LONG, AMT_CREDIT DOUBLE")
    assert drop_exact_duplicates(df).count() == 3
    assert records(duplicate_count(df)) == [{"rows": 4, "distinct_rows": 3, "duplicates_removed": 1}]


def test_formats(spark, tmp_path, frame):
    df = frame([(1, "a")], "id INT, s STRING")
    for fmt in ("csv", "parquet"):
        path = write_table(df, f"{tmp_path}/deep/t.{fmt}")
        assert records(read_table(spark, path)) == [{"id": 1, "s": "a"}]
    with pytest.raises(ValueError, match="Unsupported table format"):
        read_table(spark, "t.xlsx")
    with pytest.raises(ValueError, match="Unsupported table format"):
        write_table(df, "t.json")


def test_raw_scan_reads_missing_tokens(spark, tmp_path):
    (tmp_path / "bureau_balance.csv").write_text("SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,-1,C\n1,NA,\n1,-1,C\n")
    loaded, removed = load_raw(spark, str(tmp_path), "bureau_balance.csv")
    assert sorted((r["MONTHS_BALANCE"], r["STATUS"]) for r in loaded.collect() if r["STATUS"]) == [(-1.0, "C")]
    assert loaded.filter("STATUS IS NULL AND MONTHS_BALANCE IS NULL").count() == 1
    assert removed.first()["duplicates_removed"] == 1
    assert records(file_inventory(spark, f"{tmp_path}/*.csv"))[0]["table_name"] == "bureau_balance.csv"


def test_documents(spark, tmp_path):
    (tmp_path / "o.json").write_text('{"a": 1, "b": {"c": [1, 2]}}')
    (tmp_path / "l.json").write_text('[{"x": 1, "y": "u"}, {"x": 2, "y": "v"}]')
    (tmp_path / "v.json").write_text('[1, [2]]')
    assert [tuple(r) for r in document_rows(spark, f"{tmp_path}/o.json").collect()] == [("a", "1"), ("b", '{"c":[1,2]}')]
    assert document_rows(spark, f"{tmp_path}/l.json").count() == 2
    assert [r[0] for r in document_rows(spark, f"{tmp_path}/v.json").collect()] == ["1", "[2]"]


def test_latest_champion(spark, tmp_path):
    def run(folder, name, created, threshold, best=True):
        target = tmp_path / "reports" / folder
        target.mkdir(parents=True)
        body = {"campaign_name": name, "created_at": created}
        if best:
            body["best_model"] = {"model_name": "gbt__smote", "base_model_name": "gbt", "sampling_strategy": "smote",
                                  "threshold": threshold, "best_params": {"depth": 4}}
        (target / "campaign_metadata.json").write_text(json.dumps(body))

    run("d1/a", "main", "2024-01-01", 0.1)
    run("d2/a", "main", "2024-03-01", 0.22)
    run("d3/a", "main", "2024-09-01", 0.9, best=False)
    run("d4/a", "other", "2025-01-01", 0.5)
    broken = tmp_path / "reports" / "d5" / "a"
    broken.mkdir(parents=True)
    (broken / "campaign_metadata.json").write_text("{ not json")
    runs = scan_run_metadata(spark, f"{tmp_path}/reports/*/*/campaign_metadata.json")
    row = latest_champion(runs, "main").first()
    assert (row["threshold"], row["candidate_key"], row["model_name"], row["params"]) == (0.22, "gbt__smote", "gbt", {"depth": "4"})
    assert latest_champion(runs, "absent").count() == 0


def scored(frame):
    rows = [("r1", '{"AGE_YEARS": 30.0, "CODE_GENDER": "F"}', 0.42, 0.22, 1, "refused", 12.5),
            ("r2", '{"AGE_YEARS": 50.0}', 0.05, 0.22, 0, "approved", 8.0)]
    df = frame(rows, "request_id STRING, request_payload STRING, default_probability DOUBLE, business_threshold DOUBLE, "
                     "predicted_default INT, credit_decision STRING, latency_ms DOUBLE")
    return df.withColumn("created_at", F.lit("2024-05-01 10:00:00").cast("timestamp"))


def test_log_store_roundtrip_and_replay(spark, tmp_path, frame):
    root = str(tmp_path / "logs")
    for first in (True, False):  # the same micro-batch twice leaves one copy
        assert logs.append_logs(logs.prediction_log_rows(scored(frame)), root, batch=7) is first
    inputs = logs.load_production_inputs(spark, root).orderBy("feature_count").collect()
    assert [(r["feature_count"], r["AGE_YEARS"], r["CODE_GENDER"]) for r in inputs] == [(1, 50.0, None), (2, 30.0, "F")]
    outputs = {r["credit_decision"]: r for r in logs.load_production_outputs(spark, root).collect()}
    assert outputs["refused"]["default_probability"] == 0.42 and outputs["approved"]["business_threshold"] == 0.22
    assert logs.read_log(spark, root, "prediction_logs", since="2024-06-01").count() == 0
    assert logs.read_log(spark, root, "api_call_logs").count() == 0
    exported = logs.export_logs(spark, root, str(tmp_path / "export"))
    assert len(exported) == 4 and spark.read.option("header", True).csv(exported[0]).count() == 2


def test_a_crash_between_the_tables_leaves_no_part_of_a_prediction(spark, tmp_path, frame):
    root = str(tmp_path / "logs")
    rows = logs.prediction_log_rows(scored(frame))
    logs.append_logs(rows, root, batch=0)
    fails = F.raise_error(F.lit("lost executor")).cast("string")
    broken = {**rows, "production_outputs": rows["production_outputs"].withColumn("credit_decision", fails)}
    with pytest.raises(Exception, match="lost executor"):
        logs.append_logs(broken, root, batch=1)
    written = spark.read.parquet(f"{root}/production_inputs").count()
    assert written == 4  # the parts of two tables are there, but no reader sees them
    for table in rows:
        assert logs.read_log(spark, root, table).count() == 2
    assert logs.append_logs(rows, root, batch=1) and not logs.append_logs(rows, root, batch=1)
    assert logs.append_logs(rows, root, batch=1, writer="other")
    for table in rows:
        assert logs.read_log(spark, root, table).count() == 6
    before = sorted(map(repr, logs.read_log(spark, root, "production_outputs").collect()))
    assert logs.compact_logs(spark, root) == 3 and logs.compact_logs(spark, root) == 0
    assert logs.drop_replaced(spark, root) == 3
    assert sorted(map(repr, logs.read_log(spark, root, "production_outputs").collect())) == before
    assert not logs.append_logs(rows, root, batch=1) and logs.append_logs(rows, root, batch=2)
    assert logs.read_log(spark, root, "prediction_logs").count() == 8


def test_a_commit_of_the_same_batch_by_another_writer_wins(spark, tmp_path, frame, monkeypatch):
    root = str(tmp_path / "logs")
    rows = logs.prediction_log_rows(scored(frame))
    logs.append_logs(rows, root, batch=3)
    monkeypatch.setattr(logs, "_is_published", lambda *_: False)  # both writers looked before either had committed
    assert not logs.append_logs(rows, root, batch=3)
    assert spark.read.parquet(f"{root}/prediction_logs").count() == 2
    assert logs.append_logs({}, root) is False


def test_fallback_to_the_prediction_log(spark, tmp_path, frame):
    root = str(tmp_path / "logs")
    logs.append_log(logs.prediction_log_rows(scored(frame))["prediction_logs"], root, "prediction_logs")
    assert sorted(r["AGE_YEARS"] for r in logs.load_production_inputs(spark, root).collect()) == [30.0, 50.0]
    assert sorted(r["predicted_default"] for r in logs.load_production_outputs(spark, root).collect()) == [0, 1]


def test_call_rows_keep_payload_for_errors_only(frame):
    df = frame([("a", "POST", "/predict", 200, 1.0, "{}"), ("b", "POST", "/predict", 404, 1.0, "{}")],
               "request_id STRING, method STRING, path STRING, status_code INT, latency_ms DOUBLE, request_payload STRING")
    rows = logs.api_call_rows(df.withColumn("created_at", F.current_timestamp())).orderBy("status_code").collect()
    assert (rows[0]["request_payload"], rows[0]["error_type"], rows[0]["error_message"]) == (None, None, None)
    assert (rows[1]["request_payload"], rows[1]["error_type"], rows[1]["error_message"]) == ("{}", "http_404", "Not Found")


def test_small_sinks(spark, tmp_path, frame):
    path = write_json_lines(frame([(1, None)], "request_index INT, error STRING"), f"{tmp_path}/j")
    assert spark.read.text(path).first()[0] == '{"request_index":1,"error":null}'
    assert json.loads(spark.read.text(write_metadata(spark, {"a": {"b": 1}}, f"{tmp_path}/m")).first()[0]) == {"a": {"b": 1}}


def test_dataset_plan(spark, tmp_path):
    from riskloom.plans import views
    from riskloom.plans.registry import view

    sf, raw = "/root/testdata/sf0.001", str(tmp_path / "raw")
    for name, text in {"bureau": views.BUREAU, "bureau_balance": views.BUREAU_BALANCE, "previous_application": views.PREVIOUS,
                       "POS_CASH_balance": views.POS, "installments_payments": views.INSTALMENTS,
                       "credit_card_balance": views.CARDS}.items():
        write_table(view(spark, sf, text), f"{raw}/{name}.csv")
    clients = view(spark, sf, views.APPLICATIONS)
    even = F.col("SK_ID_CURR") % 2 == 0
    write_table(clients.filter(even).withColumn("TARGET", (F.col("SK_ID_CURR") % 6 == 0).cast("int")), f"{raw}/application_train.csv")
    write_table(clients.filter(~even), f"{raw}/application_test.csv")
    dataset = build_dataset(spark, raw)
    assert dataset.train.count() == 75 and dataset.test.count() == 75
    assert "TARGET" not in dataset.test.columns and "BURO_LOAN_COUNT" in dataset.train.columns
    coverage = {r["source"]: r["matched_clients_all"] for r in dataset.reports["merge_coverage"].collect()}
    assert coverage["bureau"] == 150 and len(coverage) == 5
    assert dataset.reports["table_profiles"].count() == 8
    written = save_dataset(dataset, str(tmp_path / "out"))
    ids = [r[0] for r in spark.read.parquet(str(tmp_path / "out" / "train_features.parquet")).select("SK_ID_CURR").collect()]
    assert sorted(ids) == list(range(0, 150, 2)) and "merge_coverage" in written
    small = dataset.train.select("SK_ID_CURR", "TARGET", "AGE_YEARS", "CODE_GENDER")
    reports = quality_reports(small, target="TARGET", ids=["SK_ID_CURR"], sample_size=40)
    assert reports["schema_summary"].count() == 4 and reports["target_distribution"].agg(F.sum("count")).first()[0] == 40
