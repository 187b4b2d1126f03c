from __future__ import annotations

import math

import numpy as np
import pytest

from riskloom.operators.association import cramers_v, feature_target_associations, signed_associations, strongest
from riskloom.operators.profiling import (
    categorical_summary,
    constant_columns,
    drop_constant_columns,
    missingness_report,
    numeric_summary,
    schema_summary,
    stack_profiles,
    table_profile,
    target_correlations,
    target_distribution,
)
from tests.conftest import records


def test_profile_counts_key_repetitions(frame):
    df = frame([(1, 100, None), (1, 101, 2.0), (2, 102, math.nan)], "SK_ID_CURR LONG, SK_ID_BUREAU LONG, x DOUBLE")
    row = table_profile(df, "bureau.csv", duplicates_removed=0).first()
    assert (row["rows"], row["columns"], row["sk_id_curr_key_repetitions"], row["sk_id_bureau_key_repetitions"]) == (3, 3, 1, 0)
    assert row["total_missing_ratio"] == pytest.approx(2 / 9)
    both = stack_profiles([table_profile(df, "bureau.csv"), table_profile(df, "other", keys=[])])
    assert both.count() == 2


def test_missingness(frame):
    df = frame([(1, None, "a"), (2, math.nan, None), (3, 1.0, "b")], "id INT, x DOUBLE, s STRING")
    rows = records(missingness_report(df, with_coverage=True))
    assert [r["column"] for r in rows] == ["x", "s"]
    assert rows[0]["missing_count"] == 2 and rows[0]["coverage_rate"] == pytest.approx(1 / 3)
    assert missingness_report(df.select("id")).count() == 0


def test_summaries(frame):
    df = frame([(1.0, "b"), (2.0, "a"), (None, "a"), (10.0, None), (3.0, "b")], "x DOUBLE, s STRING")
    schema = {r["column"]: r for r in schema_summary(df).collect()}
    assert (schema["x"]["nunique"], schema["x"]["missing_ratio"], schema["s"]["nunique"]) == (5, 20.0, 3)
    number = numeric_summary(df).first()
    values = np.array([1.0, 2.0, 10.0, 3.0])
    assert number["count"] == 4 and number["std"] == pytest.approx(values.std(ddof=1))
    assert (number["p25"], number["p50"], number["p75"]) == tuple(np.quantile(values, [0.25, 0.5, 0.75]))
    assert categorical_summary(df).first()["top_value"] == "a"
    target = {r["target"]: r["ratio"] for r in target_distribution(df, "s").collect()}
    assert target == {"a": 0.4, "b": 0.4, None: 0.2}


def test_correlations_and_constants(frame):
    df = frame([(0, 1.0, 5, None), (1, 2.0, 5, None), (1, 3.0, 5, None)], "y INT, x DOUBLE, c INT, n STRING")
    rows = {r["feature"]: r["correlation"] for r in target_correlations(df, "y").collect()}
    assert rows["y"] == pytest.approx(1.0) and rows["c"] is None
    assert rows["x"] == pytest.approx(np.corrcoef([0, 1, 1], [1, 2, 3])[0, 1])
    assert [r["column"] for r in constant_columns(df).collect()] == ["c", "n"]
    kept, dropped = drop_constant_columns(df, excluded=["c"])
    assert dropped == ["n"] and kept.columns == ["y", "x", "c"]


def _cramer(x, y):
    levels_x, levels_y = sorted(set(x)), sorted(set(y))
    table = np.array([[sum(a == i and b == j for a, b in zip(x, y)) for j in levels_y] for i in levels_x], float)
    n = table.sum()
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / n
    phi2 = ((table - expected) ** 2 / expected).sum() / n
    r, k = table.shape
    phi2 = max(0, phi2 - (k - 1) * (r - 1) / (n - 1))
    return math.sqrt(phi2 / min(k - (k - 1) ** 2 / (n - 1) - 1, r - (r - 1) ** 2 / (n - 1) - 1))


def test_associations(frame):
    rng = np.random.default_rng(1)
    rows = [(int(rng.random() < 0.4), float(rng.normal()), "abc"[rng.integers(3)], f"v{i}") for i in range(120)]
    rows = [(y, x + y, "a" if y and i % 2 else s, crowded) for i, (y, x, s, crowded) in enumerate(rows)]
    df = frame(rows, "y INT, x DOUBLE, s STRING, crowded STRING")
    found = {r["feature"]: r["score"] for r in feature_target_associations(df, "y").collect()}
    ys, xs, ss = [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]
    assert set(found) == {"x", "s"}
    assert found["x"] == pytest.approx(np.corrcoef(ys, xs)[0, 1]) and found["s"] == pytest.approx(_cramer(ss, ys))
    signed = {(r["feature"], r["modality"]): r for r in signed_associations(df, "y", min_modal_count=10).collect()}
    dummy = [int(s == "a") for s in ss]
    assert signed["s", "a"]["score"] == pytest.approx(np.corrcoef(dummy, ys)[0, 1])
    assert signed["s", "a"]["target_rate_rest"] == pytest.approx(np.mean([y for y, d in zip(ys, dummy) if not d]))
    assert strongest(feature_target_associations(df, "y"), 1).count() == 1


def test_degenerate_cramers(frame):
    df = frame([("a", 1), ("a", 0), (None, 1)], "s STRING, y INT")
    assert cramers_v(df, ["s"], "y").collect() == []
