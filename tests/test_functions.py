from __future__ import annotations

import bisect
import random

import pytest
from pyspark.sql import functions as F

from riskloom.functions import (
    average_available,
    best_of,
    bucket_index,
    capitalize_label,
    clip_low,
    f_beta,
    isclose,
    linspace,
    number,
    reason_phrase,
    safe_corr,
    safe_ratio,
    share,
    slugify,
    spread_available,
    sum0,
    sum_available,
    truncate,
)
from riskloom.functions.payload import discover_schema, flatten_json, payload_object, payload_size


def one(df, column):
    return df.select(column.alias("v")).first()["v"]


def test_ratio_of_zero_denominator_is_null(frame):
    df = frame([(10.0, 2.0), (4.0, 0.0), (None, 1.0)], "n DOUBLE, d DOUBLE")
    assert [r[0] for r in df.select(safe_ratio("n", "d")).collect()] == [5.0, None, None]


def test_share_is_zero_without_a_whole(frame):
    df = frame([(3, 0)], "a INT, b INT")
    assert one(df, share("a", "b")) == 0.0


def test_clip_keeps_null(frame):
    df = frame([(-2.0,), (3.0,), (None,)], "x DOUBLE")
    assert [r[0] for r in df.select(clip_low("x")).collect()] == [0.0, 3.0, None]


def test_row_wise_statistics_skip_null(frame):
    df = frame([(1.0, None, 3.0), (None, None, None), (2.0, None, None)], "a DOUBLE, b DOUBLE, c DOUBLE")
    columns = ["a", "b", "c"]
    rows = df.select(
        average_available(columns), spread_available(columns), best_of(columns, largest=False),
        best_of(columns, largest=True), sum_available(columns),
    ).collect()
    assert tuple(rows[0]) == (2.0, pytest.approx(2**0.5), 1.0, 3.0, 4.0)
    assert tuple(rows[1]) == (None, None, None, None, 0.0)
    assert tuple(rows[2]) == (2.0, None, 2.0, 2.0, 2.0)


def test_sum0_of_all_null_group(frame):
    df = frame([(1, None), (1, None), (2, 4.0)], "k INT, x DOUBLE")
    assert {r["k"]: r["s"] for r in df.groupBy("k").agg(sum0("x").alias("s")).collect()} == {1: 0.0, 2: 4.0}


def test_correlation_of_constant_is_null(frame):
    df = frame([(1.0, 1.0, 0.0), (2.0, 1.0, 1.0), (3.0, None, 2.0)], "x DOUBLE, c DOUBLE, y DOUBLE")
    row = df.agg(safe_corr("x", "y").alias("a"), safe_corr("x", "c").alias("b")).first()
    assert row["a"] == pytest.approx(1.0) and row["b"] is None


def test_number_coercion(frame):
    df = frame([("1.5",), ("x",), ("NaN",), (None,)], "s STRING")
    assert [r[0] for r in df.select(number("s")).collect()] == [1.5, None, None, None]


def test_f_beta(frame):
    df = frame([(0.5, 0.25), (0.0, 0.0)], "p DOUBLE, r DOUBLE")
    values = [r[0] for r in df.select(f_beta("p", "r")).collect()]
    assert values == [pytest.approx(5 * 0.125 / (4 * 0.5 + 0.25)), 0.0]


def test_grid_points_match_multiples_of_the_step(spark):
    points = [r[0] for r in spark.range(401).select(linspace("id", 401)).collect()]
    assert points[0] == 0.0 and points[400] == 1.0 and points[3] == 3 * (1 / 400)


def test_isclose(frame):
    df = frame([(0.1 + 0.2, 0.3), (0.31, 0.3)], "a DOUBLE, b DOUBLE")
    assert [r[0] for r in df.select(isclose("a", "b")).collect()] == [True, False]


def test_bucket_index_is_a_binary_search(spark):
    rng = random.Random(7)
    for size in (0, 1, 2, 5, 31, 255):
        splits = sorted(rng.uniform(0, 10) for _ in range(size))
        probes = [rng.uniform(-1, 11) for _ in range(20)] + splits[:5]
        df = spark.createDataFrame([(p,) for p in probes], "x DOUBLE")
        edges = F.array(*[F.lit(s) for s in splits]).cast("array<double>")
        found = [r[0] for r in df.select(bucket_index(edges, "x", max_splits=255)).collect()]
        assert found == [bisect.bisect_right(splits, p) for p in probes]


def test_text_helpers(frame):
    df = frame([("  Bench: Été 2024! ",), ("___",)], "s STRING")
    assert [r[0] for r in df.select(slugify("s")).collect()] == ["bench_t_2024", "benchmark"]
    assert one(frame([("EXT_SOURCE_1",)], "s STRING"), capitalize_label("s")) == "Ext source 1"
    assert len(one(frame([("x" * 900,)], "s STRING"), truncate("s"))) == 500
    codes = frame([(404,), (299,)], "c INT")
    assert [r[0] for r in codes.select(reason_phrase("c")).collect()] == ["Not Found", None]


def test_payload_parsing(frame):
    df = frame([('{"a":1,"b":2}',), ("[1]",), ("bad",), (None,)], "p STRING")
    assert [r[0] for r in df.select(payload_object("p")).collect()] == ['{"a":1,"b":2}', '{"payload":[1]}', None, None]
    assert [r[0] for r in df.select(payload_size("p")).collect()] == [2, 0, 0, 0]


def test_flatten_nested_payload(frame):
    df = frame([(1, '{"a":{"b":1.5},"k":"x"}'), (2, '{"k":"y"}'), (3, "oops")], "id INT, p STRING")
    assert discover_schema(df, "p").fieldNames() == ["a", "k"]
    flat = flatten_json(df, "p", keep=["id"], prefix="in_").orderBy("id").collect()
    assert [tuple(r) for r in flat] == [(1, 1.5, "x"), (2, None, "y"), (3, None, None)]
    assert flat[0].asDict().keys() == {"id", "in_a.b", "in_k"}
