from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators.neighbor_index import _axes, neighbor_lists, recall_of
from riskloom.operators.neighbors import nearest_neighbors
from riskloom.operators.rebalance import smote
from riskloom.settings import RebalanceSettings


def vectors(spark, points):
    return spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "rep LONG, vec ARRAY<DOUBLE>")


def brute(points, k):
    apart = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(apart, np.inf)
    return np.sort(apart, axis=1)[:, :k]


def test_rounds_go_on_until_the_recall_is_reached(spark):
    draw = np.random.default_rng(2)
    points = draw.normal(size=(700, 16))
    want = brute(points, 5)
    lists, facts = neighbor_lists(vectors(spark, points), 5, recall=0.9, rows=128, checked=100)
    got = {r["rep"]: [m["distance"] for m in r["found"]] for r in lists.collect()}
    assert len(got) == 700 and facts["recall"] >= 0.9 and facts["rounds"] < 64
    hits = sum(d <= want[i, -1] * (1 + 1e-9) for i, ds in got.items() for d in ds)
    assert hits / (700 * 5) >= 0.87  # the whole table, not only the vectors that were checked
    for ds in got.values():
        assert ds == sorted(ds)
    assert len({m["near"] for r in lists.collect() for m in r["found"]}) > 500


def test_dense_places_are_cut_further(spark):
    draw = np.random.default_rng(3)
    dense = 5.0 + 1e-3 * draw.normal(size=(400, 8))  # a third of all vectors and more in one place
    points = np.concatenate([dense, draw.normal(size=(400, 8))])
    lists, facts = neighbor_lists(vectors(spark, points), 3, recall=0.9, rows=64, checked=80)
    assert facts["recall"] >= 0.9 and lists.count() == 800
    sizes = lists.agg(F.max("compared")).first()[0]
    assert sizes <= 63 * facts["rounds"]  # no bucket was larger than asked for


def test_small_and_empty_tables_are_exact(spark):
    points = np.random.default_rng(4).normal(size=(50, 4))
    lists, facts = neighbor_lists(vectors(spark, points), 60)
    got = {r["rep"]: [m["distance"] for m in r["found"]] for r in lists.collect()}
    np.testing.assert_allclose([got[i] for i in range(50)], brute(points, 49))
    assert facts == {"rounds": 1, "recall": 1.0, "compared": 50 * 49}
    alone, _ = neighbor_lists(vectors(spark, points[:1]), 3)
    assert alone.first()["found"] == []
    none, facts = neighbor_lists(vectors(spark, points).where("false"), 3)
    assert none.count() == 0 and facts["recall"] == 1.0
    exact = spark.createDataFrame([(0, 1, 1.0), (0, 2, 2.0)], "rep LONG, near LONG, distance DOUBLE")
    assert recall_of(lists.where("false"), exact) == 0.0


def test_axes_follow_the_table(spark):
    assert _axes(1_000, 512, 64) == [2, 64, 64, 64]
    assert _axes(10_000_000, 512, 64)[:2] == [64, 64] and _axes(10_000_000, 512, 64)[2] == 2


def test_join_and_smote_take_the_index(spark):
    draw = np.random.default_rng(5)
    rows = [(i, int(i % 4 == 0), draw.normal(size=6).tolist()) for i in range(600)] + [(600 + i, 1, [9.0] * 6) for i in range(4)]
    df = spark.createDataFrame(rows, "id LONG, y INT, v ARRAY<DOUBLE>")
    found = nearest_neighbors(df, 3, id_column="id", vector="v", recall=0.9, queries=df.where("id % 100 = 0 OR id >= 600"))
    got = {r["id"]: r["neighbors"] for r in found.collect()}
    assert set(got) == {0, 100, 200, 300, 400, 500, 600, 601, 602, 603}
    assert [m["id"] for m in got[600]] == [601, 602, 603] and {m["distance"] for m in got[600]} == {0.0}
    made = smote(df, id_column="id", vector="v", label="y", settings=RebalanceSettings(oversampling_ratio=0.6, recall=0.9), trace=True)
    synthetic = made.where("synthetic").collect()
    assert len(synthetic) == int(450 * 0.6) - 154 and all(r["base_id"] is not None and r["base_id"] != r["partner_id"] for r in synthetic)
    by_id = {r[0]: np.array(r[2]) for r in rows}
    for r in synthetic[:20]:
        a, b, c = by_id[r["base_id"]], by_id[r["partner_id"]], np.array(r["v"])
        assert np.linalg.norm(a - c) + np.linalg.norm(b - c) == pytest.approx(np.linalg.norm(a - b))
