from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.aggregates import Subset, aggregate_by, category_levels, feature_name, share_rows
from riskloom.operators.cleaning import (
    align_columns,
    clean_applications,
    clean_instalments,
    conform,
    drop_non_features,
    narrow_types,
    sentinel_to_null,
    split_by_label,
    split_features_target,
    union_train_test,
)
from riskloom.operators.features import bureau_features, card_features, instalment_features, join_coverage, join_features
from tests.conftest import records


def test_clean_application_row(frame):
    row = {
        "SK_ID_CURR": 1, "DAYS_EMPLOYED": 365243, "DAYS_BIRTH": -3650, "CODE_GENDER": "XNA", "AMT_CREDIT": 100000.0,
        "AMT_INCOME_TOTAL": 50000.0, "AMT_ANNUITY": 5000.0, "AMT_GOODS_PRICE": 90000.0, "CNT_FAM_MEMBERS": 2.0,
        "CNT_CHILDREN": 1, "EXT_SOURCE_1": 0.2, "EXT_SOURCE_2": math.nan, "EXT_SOURCE_3": 0.6, "FLAG_DOCUMENT_2": 1,
        "FLAG_DOCUMENT_3": 0, "FLAG_MOBIL": 1, "FLAG_EMP_PHONE": 1, "FLAG_WORK_PHONE": 0, "FLAG_CONT_MOBILE": 1,
        "FLAG_PHONE": 1, "FLAG_EMAIL": 0, "REG_REGION_NOT_LIVE_REGION": 1, "REG_CITY_NOT_LIVE_CITY": 1,
        "LIVE_CITY_NOT_WORK_CITY": 1,
    }
    kinds = {int: "INT", float: "DOUBLE", str: "STRING"}
    df = frame([tuple(row.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in row.items()))
    out = records(clean_applications(df))[0]
    assert out["DAYS_EMPLOYED"] is None and out["DAYS_EMPLOYED_ANOM"] == 1 and out["CODE_GENDER"] is None
    assert out["CREDIT_TO_INCOME_RATIO"] == 2.0 and out["CHILDREN_RATIO"] == 0.5
    assert out["AGE_YEARS"] == pytest.approx(3650 / 365.25) and out["EMPLOYED_TO_AGE_RATIO"] is None
    assert (out["DOCUMENT_COUNT"], out["PHONE_FLAG_COUNT"], out["ADDRESS_MISMATCH_COUNT"]) == (1, 4, 3)
    assert out["EXT_SOURCES_MEAN"] == pytest.approx(0.4) and out["EXT_SOURCES_NA_COUNT"] == 1


def test_instalment_features_keep_null(frame):
    df = frame([(1, -10.0, -8.0, 100.0, 50.0), (1, -10.0, None, 0.0, None)],
               "SK_ID_CURR LONG, DAYS_INSTALMENT DOUBLE, DAYS_ENTRY_PAYMENT DOUBLE, AMT_INSTALMENT DOUBLE, AMT_PAYMENT DOUBLE")
    first, second = records(clean_instalments(df))
    assert (first["DPD"], first["DBD"], first["PAYMENT_RATIO"], first["PAYMENT_DIFF"]) == (2.0, 0.0, 0.5, 50.0)
    assert (second["DPD"], second["DBD"], second["PAYMENT_RATIO"]) == (None, None, None)


def test_sentinel_only_in_present_columns(frame):
    df = frame([(365243.0, 5.0)], "DAYS_LAST_DUE DOUBLE, other DOUBLE")
    assert records(sentinel_to_null(df, ["DAYS_LAST_DUE", "DAYS_FIRST_DUE"])) == [{"DAYS_LAST_DUE": None, "other": 5.0}]


def test_names():
    assert feature_name("BURO", "amt", "mean") == "BURO_AMT_MEAN"
    assert feature_name("BURO", " amt ", "", None) == "BURO_AMT"


def test_subset_is_null_without_rows_and_zero_for_all_null(frame):
    df = frame([(1, "A", None), (1, "B", 5.0), (2, "B", 1.0), (None, "A", 9.0)], "k LONG, s STRING, x DOUBLE")
    out = {r["k"]: r for r in aggregate_by(
        df, "k", prefix="P", spec={"x": ["sum", "mean"]}, subsets=[Subset("ACTIVE", "s", "A", {"x": ["sum", "mean"]})]).collect()}
    assert set(out) == {1, 2}
    assert (out[1]["ACTIVE_X_SUM"], out[1]["ACTIVE_X_MEAN"]) == (0.0, None)
    assert (out[2]["ACTIVE_X_SUM"], out[2]["ACTIVE_X_MEAN"], out[2]["P_X_SUM"]) == (None, None, 1.0)


def test_shares_include_missing(frame):
    df = frame([(1, "A"), (1, None), (2, "B")], "k LONG, s STRING")
    levels = category_levels(df, ["s"])
    assert levels == {"s": ["A", "B"]}
    out = {r["k"]: tuple(r)[1:] for r in aggregate_by(df, "k", prefix="P", levels=levels).collect()}
    assert out == {1: (0.5, 0.0, 0.5), 2: (0.0, 1.0, 0.0)}


def test_any_number_of_levels(spark):
    df = spark.range(30_000).selectExpr("id % 7 AS k", "concat('level', id) AS s")
    assert len(category_levels(df, ["s"])["s"]) == 30_000
    rows = share_rows(df, "k", ["s"]).agg({"share": "sum", "level": "count"}).first()
    assert abs(rows["sum(share)"] - 7) < 1e-6 and rows["count(level)"] == 30_000


def test_domain_builders(frame):
    columns = ["DAYS_CREDIT", "CREDIT_DAY_OVERDUE", "DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT", "AMT_CREDIT_MAX_OVERDUE",
               "CNT_CREDIT_PROLONG", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_LIMIT",
               "AMT_CREDIT_SUM_OVERDUE", "DAYS_CREDIT_UPDATE", "AMT_ANNUITY"]
    schema = "SK_ID_CURR LONG, SK_ID_BUREAU LONG, CREDIT_ACTIVE STRING, " + ", ".join(f"{c} DOUBLE" for c in columns)
    bureau = frame([(1, 10, "Active", *[float(i) for i in range(12)]), (1, 11, "Closed", *[2.0] * 12)], schema)
    balance = frame([(10, -1.0, "0"), (10, -3.0, "C")], "SK_ID_BUREAU LONG, MONTHS_BALANCE DOUBLE, STATUS STRING")
    row = bureau_features(bureau, balance, category_levels(bureau, ["CREDIT_ACTIVE"])).first()
    assert row["BURO_LOAN_COUNT"] == 2 and row["BURO_BB_MONTHS_BALANCE_MIN_MIN"] == -3.0
    assert row["BURO_BB_MONTHS_BALANCE_SIZE_SUM"] == 2 and row["ACTIVE_AMT_CREDIT_SUM_SUM"] == 6.0
    assert row["BURO_CREDIT_ACTIVE_ACTIVE_MEAN"] == 0.5 and row["BURO_CREDIT_ACTIVE_NAN_MEAN"] == 0.0

    plans = frame([(1, 1.0, -10.0, -8.0, 100.0, 50.0), (1, 2.0, -5.0, -6.0, 100.0, 100.0)],
                  "SK_ID_CURR LONG, NUM_INSTALMENT_VERSION DOUBLE, DAYS_INSTALMENT DOUBLE, DAYS_ENTRY_PAYMENT DOUBLE, "
                  "AMT_INSTALMENT DOUBLE, AMT_PAYMENT DOUBLE")
    row = instalment_features(plans).first()
    assert (row["INSTAL_NUM_INSTALMENT_VERSION_NUNIQUE"], row["INSTAL_DPD_SUM"], row["INSTAL_DBD_MAX"]) == (2, 2.0, 1.0)
    assert row["INSTALLMENTS_COUNT"] == 2


def test_join_and_coverage(frame):
    base = frame([(1, 1.0), (2, 0.0), (3, None)], "SK_ID_CURR LONG, TARGET DOUBLE")
    frames = {"a": frame([(1, 5.0), (3, None)], "SK_ID_CURR LONG, ax DOUBLE"), "b": frame([(2, 1)], "SK_ID_CURR LONG, bx INT")}
    joined = join_features(base, frames)
    assert joined.count() == 3
    rows = {r["source"]: r for r in join_coverage(joined, frames).collect()}
    assert (rows["a"]["matched_clients_all"], rows["a"]["matched_clients_train"], rows["a"]["coverage_ratio_test"]) == (1, 1, 0.0)
    assert rows["b"]["coverage_ratio_train"] == 0.5


def test_union_split_and_projection(frame):
    train = frame([(1, 5.0, 1)], "SK_ID_CURR LONG, x DOUBLE, TARGET INT")
    test = frame([(2, 6.0)], "SK_ID_CURR LONG, x DOUBLE")
    labelled, unlabelled = split_by_label(union_train_test(train, test))
    assert records(labelled) == [{"SK_ID_CURR": 1, "x": 5.0, "TARGET": 1}]
    assert records(unlabelled) == [{"SK_ID_CURR": 2, "x": 6.0}]
    features, target = split_features_target(train, target="TARGET", drop_columns=["SK_ID_CURR", "SK_ID_CURR"])
    assert features.columns == ["x"] and target.columns == ["TARGET"]
    with pytest.raises(ValueError, match="Missing required columns"):
        split_features_target(train, target="TARGET", drop_columns=["absent"])
    assert drop_non_features(train).columns == ["x"] and drop_non_features(test.drop("x")).columns == []
    assert [f.columns for f in align_columns(train, test)] == [["SK_ID_CURR", "x"]] * 2


def test_conform_and_narrow(frame):
    df = frame([("7", 3.5, "t")], "a STRING, b DOUBLE, c STRING")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("c", T.StringType())])
    assert records(conform(df, schema)) == [{"a": 7, "c": "t"}]
    assert records(conform(frame([("x", "t")], "a STRING, c STRING"), schema, lenient=True)) == [{"a": None, "c": "t"}]
    wide = frame([(1, 70000, 0.5, 0.1), (2, -5, 0.25, 0.2)], "a LONG, b LONG, c DOUBLE, d DOUBLE")
    assert dict(narrow_types(wide).dtypes) == {"a": "tinyint", "b": "int", "c": "float", "d": "double"}
    assert narrow_types(wide).select(F.sum("b")).first()[0] == 69995


def test_feature_joins_do_not_reshuffle_the_aggregates(frame):
    """The left-join chain adds one exchange for the base, none on top of the aggregations."""
    spark = frame([], "a INT").sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        child = frame([(1, 2.0)], "SK_ID_CURR LONG, x DOUBLE")
        frames = {n: aggregate_by(child, "SK_ID_CURR", prefix=n, spec={"x": ["sum"]}) for n in ("A", "B", "C")}
        joined = join_features(frame([(1,)], "SK_ID_CURR LONG"), frames)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 4
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_card_counts(frame):
    from riskloom.operators.features import CARD_SPEC

    names = list(CARD_SPEC)
    schema = "SK_ID_CURR LONG, SK_ID_PREV LONG, NAME_CONTRACT_STATUS STRING, " + ", ".join(f"{c} DOUBLE" for c in names)
    df = frame([(1, 5, "Active", *[1.0] * len(names)), (1, 5, "Active", *[None] * len(names)), (1, 6, None, *[3.0] * len(names))], schema)
    row = card_features(df).first()
    assert (row["CREDIT_CARD_LINE_COUNT"], row["CREDIT_CARD_PREV_COUNT"], row["CC_AMT_BALANCE_SUM"]) == (3, 2, 4.0)


def test_distinct_counts_do_not_widen_the_shuffle(spark, frame):
    from riskloom.operators.aggregates import aggregate_by

    rows = [(1, 5.0, 7), (1, 5.0, 8), (1, None, 7), (2, None, None), (None, 1.0, 1)]
    df = frame(rows, "k LONG, v DOUBLE, other INT")
    made = aggregate_by(df, "k", prefix="P", spec={"v": ["min", "nunique", "sum"]}, distinct={"OTHERS": "other"})
    got = {r["k"]: r.asDict() for r in made.collect()}
    assert got[1]["P_V_NUNIQUE"] == 1 and got[1]["OTHERS"] == 2 and got[1]["P_V_SUM"] == 10.0
    assert got[2]["P_V_NUNIQUE"] == 0 and got[2]["OTHERS"] == 0 and set(got) == {1, 2}
    plan = made.select("*")._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Aggregate(" in line and "sum(" in line]
    assert len(wide) == 2  # one partial and one final step, so its buffers are shuffled once
