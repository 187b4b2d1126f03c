from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions import bucket_index
from riskloom.operators import ranking
from riskloom.operators.ranking import exact_quantiles, hashed_rank, running_totals


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_running_totals_with_ties_null_keys_and_a_hot_value(frame, buckets):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.integers(0, 40, 300), np.full(200, 7)])
    keys = [None if i % 3 == 0 else "k" for i in range(len(values))]
    df = frame([(k, float(v)) for k, v in zip(keys, values)] + [("k", None)], "k STRING, x DOUBLE")
    rows = running_totals(df, value="x", keys=["k"], measures={"n": F.lit(1)}, buckets=buckets).collect()
    for key in (None, "k"):
        mine = np.array([v for k, v in zip(keys, values) if k == key])
        found = {r["x"]: r for r in rows if r["k"] == key}
        assert set(found) == set(mine.astype(float))
        for x, r in found.items():
            assert (r["n"], r["n_before"], r["n_total"]) == ((mine == x).sum(), (mine < x).sum(), len(mine))


def test_quantiles_match_linear_interpolation(frame):
    rng = np.random.default_rng(5)
    values = np.round(rng.lognormal(3, 1, 501), 2)
    df = frame([(float(v),) for v in values], "x DOUBLE")
    spots = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.95, "e": 1.0}
    row = exact_quantiles(df, value="x", quantiles=spots, buckets=16).first()
    for name, q in spots.items():
        assert row[name] == pytest.approx(np.quantile(values, q))


def test_small_quantiles_and_empty_input(frame):
    df = frame([(1.0,), (2.0,), (3.0,), (10.0,)], "x DOUBLE")
    assert exact_quantiles(df, value="x", quantiles={"p": 0.95}).first()["p"] == pytest.approx(8.95)
    assert exact_quantiles(df.filter("x > 99"), value="x", quantiles={"p": 0.5}).first()["p"] is None


def test_hashed_rank_is_a_permutation_per_group(spark):
    df = spark.range(500).withColumn("k", F.when(F.col("id") % 10 == 0, "rare").otherwise("hot"))
    ranked = hashed_rank(df, keys=["k"], ids=["id"], seed=1, buckets=8).collect()
    for key, size in (("rare", 50), ("hot", 450)):
        assert sorted(r["rank"] for r in ranked if r["k"] == key) == list(range(1, size + 1))
    again = {r["id"]: r["rank"] for r in hashed_rank(df.repartition(7), keys=["k"], ids=["id"], seed=1, buckets=8).collect()}
    assert again == {r["id"]: r["rank"] for r in ranked}


def test_bucket_search_of_running_totals(frame):
    """The compiled steps find what bucket_index finds, at cuts, between them, for NaN and without cuts."""
    rows = [(v, [0.5 * i for i in range(n)]) for v in (-1.0, 0.0, 0.7, 1.0, 3.0, 99.0, float("nan")) for n in (0, 1, 2, 7)]
    df = frame([*rows, (1.0, None)], "v DOUBLE, __cuts ARRAY<DOUBLE>").withColumn("plain", bucket_index("__cuts", "v", max_splits=7))
    found = ranking._with_bucket(df, "v", 7).collect()
    assert len(found) == 29 and all(r["__bucket"] == r["plain"] for r in found)


def test_running_totals_share_the_shuffle_of_the_values(frame):
    df = frame([(i % 3, float(i % 50)) for i in range(300)], "k INT, v DOUBLE")
    totals = running_totals(df, value="v", measures={"n": F.lit(1)}, keys=["k"])
    assert sorted((r["k"], r["n_total"]) for r in totals.collect())[::50] == [(0, 100), (1, 100), (2, 100)]
    plan = totals._jdf.queryExecution().executedPlan().toString()
    first = plan[: plan.index("Initial Plan")]
    values = [x for x in first.split("\n") if "Exchange hashpartitioning(k#" in x]
    assert len([x for x in values if "Reused" not in x]) == 1 and len(values) == 3
    assert "lambdafunction" not in first
