from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators.drift import (
    all_drift,
    asymptotic_ks_pvalue,
    categorical_drift,
    drift_level,
    drift_summary,
    exact_ks_pvalue,
    histogram,
    ks_pvalue,
    numeric_drift,
    strongest_drift,
)
from riskloom.operators.oplogs import (
    api_call_summary,
    bottlenecks,
    fk_violations,
    latency_by_path,
    latency_summary,
    latest_rows,
    measurement_summary,
    monitoring_summary,
    operational_alerts,
    prediction_summary,
    status_code_summary,
)
from riskloom.settings import DriftSettings
from tests.conftest import records

CALLS = "path STRING, status_code INT, latency_ms DOUBLE, created_at TIMESTAMP"


def test_numeric_drift_of_a_shift(frame):
    reference = frame([(float(x),) for x in (100, 110, 120, 130, 150, 160)], "AMT_INCOME_TOTAL DOUBLE")
    current = frame([(float(x),) for x in (500, 510, 520, 540)], "AMT_INCOME_TOTAL DOUBLE")
    row = numeric_drift(reference, current, settings=DriftSettings(bins=3, min_current_rows=1)).first()
    assert row["psi"] > 0 and row["ks_statistic"] == 1.0 and row["drift_level"] == "high"
    few = numeric_drift(reference, current).first()
    assert few["drift_level"] == "insufficient_data" and few["current_rows"] == 4


def test_numeric_drift_matches_numpy(frame):
    rng = np.random.default_rng(2)
    ref, cur = np.round(rng.normal(0, 1, 400), 1), np.round(rng.normal(0.3, 1.2, 250), 1)
    reference = frame([(float(v), 1.0, None) for v in ref], "x DOUBLE, flat DOUBLE, gone DOUBLE")
    current = frame([(float(v), 2.0, 1.0) for v in cur] + [(None, 1.0, 1.0)], "x DOUBLE, flat DOUBLE, gone DOUBLE")
    rows = numeric_drift(reference, current).collect()
    assert [r["feature"] for r in rows] == ["x"]
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, 11)))
    edges[0], edges[-1] = -np.inf, np.inf
    e, o = (np.clip(np.histogram(v, edges)[0] / len(v), 1e-6, None) for v in (ref, cur))
    grid = np.unique(np.concatenate([ref, cur]))
    gap = max(abs((ref <= g).mean() - (cur <= g).mean()) for g in grid)
    assert rows[0]["psi"] == pytest.approx(((o - e) * np.log(o / e)).sum())
    assert rows[0]["ks_statistic"] == pytest.approx(gap) and 0 <= rows[0]["ks_pvalue"] <= 1
    assert rows[0]["current_missing_rate"] == pytest.approx(1 / 251) and rows[0]["mean_delta"] == pytest.approx(cur.mean() - ref.mean())


def test_single_bin_gives_no_psi(frame):
    reference = frame([(0.0,)] * 30 + [(1.0,)], "x DOUBLE")
    row = numeric_drift(reference, frame([(1.0,)] * 40, "x DOUBLE")).first()
    assert row["psi"] == 0.0 and row["ks_statistic"] > 0.9 and row["drift_level"] == "high"


def test_categorical_drift(frame):
    reference = frame([("F",), ("F",), ("M",), ("M",)], "CODE_GENDER STRING")
    current = frame([("XNA",), ("XNA",), ("F",), (None,)], "CODE_GENDER STRING")
    row = categorical_drift(reference, current, settings=DriftSettings(min_current_rows=1)).first()
    assert row["psi"] > 0 and row["drift_level"] == "high"
    assert (row["reference_unique_count"], row["current_unique_count"], row["current_missing_rate"]) == (2, 2, 0.25)


def test_rare_categories_share_a_bucket(frame):
    reference = frame([(f"c{i:02d}",) for i in range(30)], "s STRING")
    current = frame([(f"c{i:02d}",) for i in range(20)] + [(f"new{i}",) for i in range(10)], "s STRING")
    row = categorical_drift(reference, current).first()
    assert row["psi"] == pytest.approx(0.0) and row["reference_unique_count"] == 30


def test_drift_levels_and_summary(frame):
    df = frame([(0.3, 0.0, 50), (0.1, 0.0, 50), (0.0, 0.2, 50), (0.0, 0.0, 50), (0.9, 0.0, 5)], "p DOUBLE, m DOUBLE, n INT")
    levels = [r[0] for r in df.select(drift_level(F.col("p"), F.col("m"), F.col("n"), 30)).collect()]
    assert levels == ["high", "moderate", "high", "low", "insufficient_data"]
    reference, current = frame([(1.0, "a"), (2.0, "b")], "x DOUBLE, s STRING"), frame([(3.0, "c")], "x DOUBLE, s STRING")
    both = all_drift(numeric_drift(reference, current), categorical_drift(reference, current))
    row = drift_summary(both).first()
    assert (row["feature_count"], row["insufficient_data_count"]) == (2, 2) and row["max_psi"] >= row["mean_psi"]
    assert strongest_drift(both, 1).count() == 1
    empty = drift_summary(both.filter("false")).first()
    assert tuple(empty) == (0, 0, 0, 0, 0.0, 0.0)


def test_histogram_closes_the_last_bin(frame):
    df = frame([(0.0,), (1.0,), (2.0,), (10.0,), (None,)], "x DOUBLE")
    rows = {r["bin"]: r["count"] for r in histogram(df, "x", bins=5).collect()}
    assert rows == {1: 2, 2: 1, 5: 1}
    assert [r["count"] for r in histogram(frame([(4.0,), (4.0,)], "x DOUBLE"), "x").collect()] == [2]


def calls(frame):
    rows = [("/predict", 200, 10.0, None), ("/predict", 422, 30.0, None), (None, 500, 20.0, None), ("/health", 200, None, None)]
    return frame(rows, CALLS)


def test_call_summary_and_empty_log(frame):
    row = api_call_summary(calls(frame)).first()
    assert (row["total_calls"], row["predict_calls"], row["error_calls"], row["error_rate"]) == (4, 2, 2, 0.5)
    assert (row["latency_mean_ms"], row["latency_p50_ms"], row["latency_max_ms"]) == (20.0, 20.0, 30.0)
    empty = api_call_summary(frame([], CALLS)).first()
    assert tuple(empty)[:9] == (0, 0, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0) and empty["first_call_at"] is None


def test_paths_and_codes(frame):
    rows = {r["path"]: r for r in latency_by_path(calls(frame)).collect()}
    assert rows["/predict"]["latency_p95_ms"] == pytest.approx(29.0)
    assert rows[None]["count"] == 1 and rows["/health"]["latency_p95_ms"] is None
    assert records(status_code_summary(calls(frame)))[0] == {"status_code": 200, "count": 2, "rate": 0.5}


def test_predictions_and_monitoring_maps(frame):
    predictions = frame([(0.1, "approved"), (0.9, "refused"), (None, None)], "default_probability DOUBLE, credit_decision STRING")
    row = prediction_summary(predictions).first()
    assert (row["prediction_count"], row["refused_rate"], row["default_probability_p50"]) == (3, pytest.approx(1 / 3), 0.5)
    summary = monitoring_summary(calls(frame), predictions).first()
    assert summary["status_code_counts"] == {"200": 2, "422": 1, "500": 1}
    assert summary["decision_counts"] == {"approved": 1, "refused": 1}


def test_alerts_and_bottlenecks(frame):
    api = frame([(0.2, 1200.0)], "error_rate DOUBLE, latency_p95_ms DOUBLE")
    alerts = operational_alerts(api, latency_warning_ms=1000, error_rate_warning=0.05).collect()
    assert [a["metric"] for a in alerts] == ["error_rate", "latency_p95_ms"]
    assert operational_alerts(api, latency_warning_ms=1200, error_rate_warning=0.2).count() == 0
    model = frame([("m", 100.0)], "source STRING, latency_p95_ms DOUBLE")
    found = [r["severity"] for r in bottlenecks(api, model, latency_warning_ms=1000, error_rate_warning=0.05).collect()]
    assert found == ["high", "high", "moderate"]
    idle = frame([(0.0, 0.0)], "error_rate DOUBLE, latency_p95_ms DOUBLE")
    assert [r["severity"] for r in bottlenecks(idle, model, latency_warning_ms=1, error_rate_warning=0.1).collect()] == ["low"]


def test_measurements_and_latency(frame):
    df = frame([(True, 10.0), (False, 20.0), (None, None)], "success BOOLEAN, client_latency_ms DOUBLE")
    row = measurement_summary(df).first()
    assert (row["request_count"], row["success_count"], row["error_count"], row["client_latency_p50_ms"]) == (3, 1, 2, 15.0)
    assert latency_summary(df, source="c", column="client_latency_ms").first()["count"] == 2


def test_integrity_and_latest(frame):
    parent = frame([(1,), (2,)], "id LONG")
    child = frame([(1,), (1,), (9,)], "prediction_log_id LONG")
    rows = {(r["violation"], r["prediction_log_id"]): r["rows"] for r in fk_violations(child, parent).collect()}
    assert rows == {("orphan", 9): 1, ("repeated_reference", 1): 2}
    df = frame([(1, 5), (2, 7), (3, 6)], "id INT, created_at INT")
    assert [r["id"] for r in latest_rows(df, 2, ties=["id"]).collect()] == [2, 3]


def test_exact_ks_pvalue_equals_counting_every_order(frame):
    cases = [(n, m, h) for n, m in ((1, 1), (2, 3), (4, 4), (5, 3), (6, 7)) for h in {1, n, m, n * m // 2, n * m, n * m + 1}]
    rows = frame([(i, *c) for i, c in enumerate(cases)], "i INT, n LONG, m LONG, h LONG")
    got = {r["i"]: r["p"] for r in rows.select("i", exact_ks_pvalue(F.col("h"), F.col("n"), F.col("m")).alias("p")).collect()}
    for i, (n, m, h) in enumerate(cases):
        orders = far = 0
        for places in combinations(range(n + m), n):
            a = b = 0
            worst = 0
            for k in range(n + m):
                a, b = a + (k in places), b + (k not in places)
                worst = max(worst, abs(a * m - b * n))
            orders, far = orders + 1, far + (worst >= h)
        assert got[i] == pytest.approx(far / orders, abs=1e-12)


def test_ks_pvalue_of_larger_samples(frame):
    rows = frame([(0, 3000, 2500), (200_000, 3000, 2500), (400_000, 3000, 2500), (7_500_000, 3000, 2500), (5, 20_000, 4)], "h LONG, n LONG, m LONG")
    statistic = F.col("h") / (F.col("n") * F.col("m"))
    exact, near = (exact_ks_pvalue(F.col("h"), F.col("n"), F.col("m")), asymptotic_ks_pvalue(statistic, F.col("n"), F.col("m")))
    got = rows.select("h", exact.alias("exact"), near.alias("near"), ks_pvalue(statistic, F.col("h"), F.col("n"), F.col("m")).alias("p")).collect()
    assert got[0]["exact"] == 1.0 and 0 < got[3]["exact"] < 1e-300 or got[3]["exact"] == 0.0
    for r in got[1:3]:
        assert r["exact"] == pytest.approx(r["near"], abs=0.02) and r["p"] == r["exact"]
    assert got[4]["exact"] is None and got[4]["p"] == got[4]["near"]
