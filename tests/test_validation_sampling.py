from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import sampling
from riskloom.operators.imputation import fill_values, impute, medians, modes, repair_ranges, replay_frame
from riskloom.operators.neighbors import nearest_neighbors
from riskloom.operators.rebalance import rebalance, strategies
from riskloom.operators.validation import RequestField, invalid_payloads, parse_requests, valid_payloads, validate_rows
from tests.conftest import records

FIELDS = [RequestField("AGE_YEARS", "float"), RequestField("AMT_INCOME_TOTAL", "double"), RequestField("CNT_CHILDREN", "int"),
          RequestField("CODE_GENDER", "string", required=False)]


@pytest.mark.parametrize("column,value,ok", [
    ("FLAG_MOBIL", 1.0, True), ("FLAG_MOBIL", 2.0, False), ("FLAG_DOCUMENT_21", 0.5, False), ("EXT_SOURCE_1", 1.0, True),
    ("EXT_SOURCES_MEAN", 1.01, False), ("EXT_SOURCES_NA_COUNT", 4.0, False), ("HOUR_APPR_PROCESS_START", 23.0, True),
    ("REGION_RATING_CLIENT", 0.0, False), ("AGE_YEARS", 17.9, False), ("AGE_YEARS", 18.0, True), ("AMT_CREDIT", 0.0, False),
    ("CNT_CHILDREN", -1.0, False), ("CNT_FAM_MEMBERS", None, True),
])
def test_rules(frame, column, value, ok):
    row = validate_rows(frame([(value,)], f"{column} DOUBLE")).first()
    assert (row["violations"] == []) is ok


def test_requests(frame):
    payloads = ['{"AGE_YEARS": 30, "AMT_INCOME_TOTAL": 5, "CNT_CHILDREN": 0}', '{"AGE_YEARS": 30, "CNT_CHILDREN": 0}',
                '{"AGE_YEARS": "old", "AMT_INCOME_TOTAL": -5, "CNT_CHILDREN": 1.5, "CODE_GENDER": 3}', "[1]"]
    df = frame([(p,) for p in payloads], "request_payload STRING")
    found = [r["violations"] for r in parse_requests(df, FIELDS).collect()]
    assert found[0] == [] and found[1] == ["AMT_INCOME_TOTAL: field required."]
    assert found[2] == ["AGE_YEARS: wrong type.", "CNT_CHILDREN: wrong type.", "CODE_GENDER: wrong type.",
                        "AMT_INCOME_TOTAL must be strictly positive."]
    assert found[3] == ["payload: not a JSON object."]


def test_payloads(frame):
    df = frame([(1, 0, 2.5, math.nan)], "SK_ID_CURR INT, TARGET INT, a DOUBLE, b DOUBLE")
    assert valid_payloads(df).first()[0] == '{"a":2.5,"b":null}'
    assert invalid_payloads(df, "a").first()[0] == '{"b":null}'


def test_fill_values(frame):
    df = frame([(1.0, "b", True, None), (math.inf, "a", None, None), (3.0, "b", False, None), (None, "a", True, None)],
               "x DOUBLE, s STRING, f BOOLEAN, e STRING")
    values = fill_values(df)
    assert values == {"x": 2.0, "s": "a", "f": False, "e": "missing"}
    assert records(impute(df, values))[1] == {"x": 2.0, "s": "a", "f": False, "e": "missing"}
    assert medians(df, ["x"]).first()["median"] == 2.0 and modes(df, ["s"]).first()["mode"] == "a"


def test_repaired_rows_pass_validation(frame):
    df = frame([(1, 0, math.nan, -5.0, math.inf, -2, 3.0, 7.0, -0.5, None), (2, 1, 150.0, 10.0, 5.0, 1, 0.2, 1.0, 1.5, 9.0)],
               "SK_ID_CURR INT, TARGET INT, AGE_YEARS DOUBLE, AMT_INCOME_TOTAL DOUBLE, AMT_CREDIT DOUBLE, CNT_CHILDREN INT, "
               "FLAG_MOBIL DOUBLE, REGION_RATING_CLIENT DOUBLE, EXT_SOURCE_1 DOUBLE, EXT_SOURCES_NA_COUNT DOUBLE")
    fixed = replay_frame(df)
    assert all(r["violations"] == [] for r in validate_rows(fixed).collect())
    first = records(repair_ranges(df))[0]
    assert (first["AGE_YEARS"], first["AMT_INCOME_TOTAL"], first["FLAG_MOBIL"], first["EXT_SOURCE_1"]) == (35.0, 50000.0, 1, 0.0)


@pytest.fixture
def clients(spark, monkeypatch):
    monkeypatch.setattr(sampling, "ROWS_PER_SLICE", 20)  # many slices, so cuts fall inside them
    return spark.range(1000).withColumn("y", (F.col("id") % 7 == 0).cast("int"))


def sizes(df, *keys):
    return {tuple(r)[:-1]: r["n"] for r in df.groupBy(*keys).agg(F.count_distinct("id").alias("n")).collect()}


def test_stratified_sample_is_exact_and_repeatable(clients):
    drawn = sampling.stratified_sample(clients, label="y", ids=["id"], size=100)
    assert sizes(drawn, "y") == {(0,): 86, (1,): 14} and drawn.count() == 100
    again = sampling.stratified_sample(clients.repartition(5), label="y", ids=["id"], size=100)
    assert {r["id"] for r in drawn.collect()} == {r["id"] for r in again.collect()}
    other = sampling.stratified_sample(clients, label="y", ids=["id"], size=100, seed=1)
    assert {r["id"] for r in other.collect()} != {r["id"] for r in drawn.collect()}
    assert sampling.stratified_sample(clients, label="y", ids=["id"], size=2000) is clients


def test_split_and_folds_cover_every_row_once(clients):
    split = sampling.stratified_split(clients, label="y", ids=["id"])
    assert sizes(split, "y", "is_holdout") == {(0, True): 171, (1, True): 29, (0, False): 686, (1, False): 114}
    folds = sampling.stratified_folds(clients, label="y", ids=["id"], k=3)
    assert folds.count() == 1000 and folds.select("id").distinct().count() == 1000
    assert sorted(sizes(folds, "y", "fold").values()) == [47, 48, 48, 285, 286, 286]


def test_undersample_and_weights(clients):
    assert sizes(sampling.undersample(clients, label="y", ids=["id"]), "y") == {(1,): 143, (0,): 204}
    row = sampling.class_weight_ratio(clients.limit(0).unionByName(clients), "y").first()
    assert row["ratio"] == pytest.approx(857 / 143)
    weights = {r["y"]: r["w"] for r in sampling.balanced_weights(clients, "y").groupBy("y").agg(F.sum("class_weight").alias("w")).collect()}
    assert weights[0] == pytest.approx(weights[1])
    assert sampling.random_sample(clients, 10, ids=["id"]).count() == 10


def vectors(spark, copies=True):
    rng = np.random.default_rng(4)
    points = [(i, [float(v) for v in rng.normal(size=4)], int(i % 6 == 0)) for i in range(150)]
    if copies:  # a third of all rows are one vector
        points += [(1000 + i, points[6][1], i % 2) for i in range(75)]
    return points, spark.createDataFrame(points, "id LONG, v ARRAY<DOUBLE>, y INT")


@pytest.mark.parametrize("block", [16, 8192])
def test_neighbors_match_brute_force(spark, block):
    points, df = vectors(spark)
    ids, data = np.array([p[0] for p in points]), np.array([p[1] for p in points])
    found = {r["id"]: [n["id"] for n in r["neighbors"]] for r in nearest_neighbors(df, 4, id_column="id", vector="v", block=block).collect()}
    assert len(found) == len(points)
    for i, own in enumerate(ids):
        distance = np.sqrt(((data - data[i]) ** 2).sum(1))
        expected = [int(ids[j]) for j in np.lexsort((ids, distance)) if j != i][:4]
        assert found[int(own)] == expected


@pytest.mark.parametrize("strategy", ["smote", "borderline_smote", "adasyn", "smote_under"])
def test_rebalancing(spark, strategy):
    points, df = vectors(spark, copies=False)
    minority = np.array([p[1] for p in points if p[2]])
    out = rebalance(df, strategy, id_column="id", vector="v", label="y")
    rows = out.collect()
    made = [r for r in rows if r["synthetic"]]
    real = [r for r in rows if not r["synthetic"]]
    need = int(0.3 * 125) - 25
    assert all(r["y"] == 1 and r["id"] is None for r in made)
    assert abs(len(made) - need) <= (6 if strategy == "adasyn" else 0)
    assert len(real) == (150 if strategy != "smote_under" else 25 + int((25 + need) / 0.7))
    low, high = minority.min(0) - 1e-9, minority.max(0) + 1e-9
    assert all((low <= np.array(r["v"])).all() and (np.array(r["v"]) <= high).all() for r in made)
    if strategy == "smote":
        again = rebalance(df.repartition(3), strategy, id_column="id", vector="v", label="y").filter("synthetic").collect()
        assert sorted(tuple(r["v"]) for r in again) == sorted(tuple(r["v"]) for r in made)


def test_balanced_data_is_left_alone(spark):
    df = spark.createDataFrame([(i, [float(i)], i % 2) for i in range(20)], "id LONG, v ARRAY<DOUBLE>, y INT")
    out = rebalance(df, "smote", id_column="id", vector="v", label="y")
    assert out.count() == 20 and out.filter("synthetic").count() == 0
    with pytest.raises(ValueError):
        rebalance(df, "magic", id_column="id", vector="v", label="y")
    with pytest.raises(ValueError):
        strategies(["smote", "magic"])


def test_samples_of_a_label_with_twenty_thousand_classes(spark):
    df = spark.range(60_000).select("id", (F.col("id") % 20_000).cast("string").alias("y"))
    drawn = sampling.stratified_sample(df, label="y", ids=["id"], size=20_000)
    sizes = drawn.groupBy("y").count().groupBy("count").count().collect()
    assert [tuple(r) for r in sizes] == [(1, 20_000)]
    folds = sampling.stratified_folds(df, label="y", ids=["id"], k=3, fold="fold")
    assert folds.groupBy("y", "fold").count().filter("count <> 1").count() == 0 and folds.count() == 60_000


def test_classes_with_null_and_equal_sizes_keep_their_quota(frame):
    df = frame([(i, None if i % 3 == 0 else f"c{i % 3}") for i in range(90)], "id LONG, y STRING")
    assert {r["y"]: r["count"] for r in sampling.stratified_sample(df, label="y", ids=["id"], size=30).groupBy("y").count().collect()} == {None: 10, "c1": 10, "c2": 10}
