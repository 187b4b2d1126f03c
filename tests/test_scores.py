from __future__ import annotations

import numpy as np
import pytest

from riskloom.operators.fairness import age_band, disparity_summary, enrich_predictions, fairness_report, fairness_table, lost_predictions
from riskloom.operators.scorecurve import (
    best_threshold,
    business_cost,
    curve_points,
    evaluate_threshold,
    ranking_metrics,
    threshold_selection_summary,
    threshold_sweep,
)
from riskloom.settings import CostModel
from tests.conftest import records

SMALL = [(0, 0.1), (0, 0.4), (1, 0.65), (1, 0.95)]


def at_threshold(y, s, t, fn_cost=10.0):
    p = s >= t
    tp, fp = int((p & (y == 1)).sum()), int((p & (y == 0)).sum())
    fn, tn = int((~p & (y == 1)).sum()), int((~p & (y == 0)).sum())
    return {"cost": (fn_cost * fn + fp) / len(y), "tp": tp, "fp": fp, "fn": fn, "tn": tn}


def brute(y, s, t):
    pairs = sum((a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0])
    auc = pairs / ((y == 1).sum() * (y == 0).sum())
    ap, last, ks = 0.0, 0.0, 0.0
    for c in sorted(set(s), reverse=True):
        hit = s >= c
        recall, fall = (hit & (y == 1)).sum() / (y == 1).sum(), (hit & (y == 0)).sum() / (y == 0).sum()
        ap += (recall - last) * (hit & (y == 1)).sum() / hit.sum()
        last, ks = recall, max(ks, recall - fall)
    return {**at_threshold(y, s, t), "auc": auc, "ap": ap, "ks": ks, "brier": float(((s - y) ** 2).mean())}


@pytest.fixture
def scored(frame):
    rng = np.random.default_rng(11)
    y = (rng.random(300) < 0.3).astype(int)
    s = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)
    return y, s, frame([(int(a), float(b)) for a, b in zip(y, s)], "y INT, s DOUBLE")


def test_metrics_match_brute_force(scored):
    y, s, df = scored
    row, expected = ranking_metrics(df, label="y", score="s").first(), brute(y, s, 0.5)
    for ours, theirs in (("roc_auc", "auc"), ("average_precision", "ap"), ("ks_statistic", "ks"), ("brier_score", "brier")):
        assert row[ours] == pytest.approx(expected[theirs])
    at = evaluate_threshold(df, label="y", score="s", threshold=0.5).first()
    assert at["business_cost"] == pytest.approx(expected["cost"])
    assert [at[c] for c in ("true_negatives", "false_positives", "false_negatives", "true_positives")] == [
        expected[c] for c in ("tn", "fp", "fn", "tp")]


def test_best_threshold_is_the_least_cost_candidate(scored):
    y, s, df = scored
    candidates = sorted(set(np.linspace(0, 1, 401)) | set(s))
    rated = [(at_threshold(y, s, t)["cost"], -at_threshold(y, s, t)["tp"], t) for t in candidates]
    best = best_threshold(df, label="y", score="s").first()
    assert (best["business_cost"], best["threshold"]) == (pytest.approx(min(rated)[0]), pytest.approx(min(rated)[2]))
    sweep = threshold_sweep(df, label="y", score="s").orderBy("threshold").collect()
    assert len(sweep) == len(candidates)
    for r in sweep[::37]:
        assert r["business_cost"] == pytest.approx(at_threshold(y, s, r["threshold"])["cost"])


def test_sweep_holds_an_extra_threshold_once(frame):
    df = frame(SMALL, "y INT, s DOUBLE")
    rows = threshold_sweep(df, label="y", score="s", cost=CostModel(grid_size=11), extra_thresholds=[0.4, 0.123]).collect()
    thresholds = [r["threshold"] for r in rows]
    assert thresholds.count(0.123) == 1 and thresholds.count(0.4) == 1 and len(thresholds) == len(set(thresholds))


def test_one_class(frame):
    row = evaluate_threshold(frame([(0, 0.2), (0, 0.8)], "y INT, s DOUBLE"), label="y", score="s", threshold=0.5).first()
    assert row["roc_auc"] is None and row["average_precision"] is None and row["ks_statistic"] is None
    assert (row["precision"], row["recall"], row["balanced_accuracy"]) == (0.0, 0.0, 0.5)


def test_false_negatives_cost_more(frame):
    misses = frame([(1, 0), (1, 1), (0, 0), (0, 0)], "y INT, p INT")
    alarms = frame([(1, 1), (1, 1), (0, 1), (0, 0)], "y INT, p INT")
    first, second = (business_cost(d, label="y", prediction="p").first() for d in (misses, alarms))
    assert first["business_cost"] == 2.5 and second["business_cost"] == 0.25 and first["total_cost"] == 10.0


def test_grouped_best_threshold(frame):
    df = frame([("a", *r) for r in SMALL] + [("b", 1, 0.9), ("b", 0, 0.05)], "g STRING, y INT, s DOUBLE")
    rows = {r["g"]: r for r in best_threshold(df, label="y", score="s", keys=["g"]).collect()}
    assert rows["a"]["business_cost"] == 0.0 and rows["b"]["roc_auc"] == 1.0


def test_selection_summary(frame):
    df = frame(SMALL, "y INT, s DOUBLE")
    row = threshold_selection_summary(df, df, label="y", score="s", selected=0.65, model_name="m").first()
    assert row["oof_recall_at_selected_threshold"] == 1.0 and row["holdout_min_business_cost"] == 0.0
    assert curve_points(df, label="y", score="s").count() == 4


def test_age_bands(frame):
    df = frame([(19.9,), (20.0,), (29.9,), (30.0,), (60.0,), (99.0,), (100.0,), (None,)], "a DOUBLE")
    assert [r[0] for r in df.select(age_band("a")).collect()] == [None, "20-29", "20-29", "30-39", "60+", "60+", None, None]


def test_group_rates(frame):
    df = frame([("g", 1, 1), ("g", 1, 0), ("g", 0, 0), ("g", 0, 1), ("g", 1, 1)], "g STRING, TARGET INT, prediction INT")
    row = fairness_table(df, group="g").first()
    assert (row["n"], row["n_positive_target"], row["selection_rate"], row["fpr"]) == (5, 3, 0.6, 0.5)
    assert row["recall"] == pytest.approx(2 / 3)


def test_null_group_is_left_out(frame):
    df = frame([("M", 1, 1), ("F", 0, 0), ("M", 0, 1), ("F", 1, 1), (None, 1, 1)], "CODE_GENDER STRING, TARGET INT, prediction INT")
    rows = {r["group"]: r["n"] for r in fairness_table(df, group="CODE_GENDER").collect()}
    assert rows == {"F": 2, "M": 2}


def test_disparity(frame):
    table = frame([("a", 0.8, 0.7), ("b", 0.2, 0.5)], "group STRING, selection_rate DOUBLE, recall DOUBLE")
    row = disparity_summary(table).first()
    assert row["disparate_impact_ratio"] == pytest.approx(0.25) and row["flag_disparate_impact"]
    assert row["equal_opportunity_difference"] == pytest.approx(0.2)
    alone = disparity_summary(table.limit(1)).first()
    assert (alone["disparate_impact_ratio"], alone["equal_opportunity_difference"], alone["flag_disparate_impact"]) == (None, None, False)


def test_fairness_report_and_enrichment(frame):
    rows = [(i, "MF"[i % 2], 22 + 4 * i, i % 3 == 0, i % 2) for i in range(12)]
    df = frame([(a, g, y, int(t), p) for a, g, y, t, p in rows], "SK_ID_CURR LONG, CODE_GENDER STRING, AGE_YEARS INT, TARGET INT, prediction INT")
    report = fairness_report(df)
    assert {r["group"]: r["n"] for r in report["fairness_by_gender"].collect()} == {"M": 6, "F": 6}
    assert report["fairness_by_age_band"].count() <= 5
    assert [r["attribute"] for r in report["fairness_summary"].collect()] == ["gender", "age_band"]
    attributes = df.select("SK_ID_CURR", "CODE_GENDER").filter("SK_ID_CURR > 2")
    predictions = df.select("SK_ID_CURR", "prediction")
    assert enrich_predictions(predictions, attributes).count() == 9
    assert sorted(r["SK_ID_CURR"] for r in records_of(lost_predictions(predictions, attributes))) == [0, 1, 2]


def records_of(df):
    return records(df)
