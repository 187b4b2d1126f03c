"""Client features from the child tables, the left-join assembly and its coverage report.

Shares of category levels are made for the ``levels`` passed in (see ``aggregates.category_levels``), none without.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.aggregates import Subset, aggregate_by
from riskloom.operators.cleaning import clean_instalments, clean_previous_applications

CLIENT_KEY = "SK_ID_CURR"

# ---- Fixed values: aggregation specs, "COLUMN: aggregates" -------------------------------------
BALANCE_SPEC = {
    "MONTHS_BALANCE": ["min", "max", "size"],
}

BUREAU_SPEC = {
    "DAYS_CREDIT": ["min", "max", "mean", "var"],
    "CREDIT_DAY_OVERDUE": ["max", "mean"],
    "DAYS_CREDIT_ENDDATE": ["min", "max", "mean"],
    "DAYS_ENDDATE_FACT": ["min", "max", "mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["max", "mean"],
    "CNT_CREDIT_PROLONG": ["sum", "mean"],
    "AMT_CREDIT_SUM": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_LIMIT": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["max", "mean", "sum"],
    "DAYS_CREDIT_UPDATE": ["min", "max", "mean"],
    "AMT_ANNUITY": ["max", "mean"],
    "BB_MONTHS_BALANCE_MIN": ["min"],
    "BB_MONTHS_BALANCE_MAX": ["max"],
    "BB_MONTHS_BALANCE_SIZE": ["mean", "sum"],
}
BUREAU_SUBSETS = [
    Subset("ACTIVE", "CREDIT_ACTIVE", "Active", {
        "AMT_CREDIT_SUM": ["sum", "mean"],
        "AMT_CREDIT_SUM_DEBT": ["sum", "mean"],
        "AMT_CREDIT_SUM_OVERDUE": ["sum", "mean"],
        "AMT_ANNUITY": ["mean", "max"],
    }),
    Subset("CLOSED", "CREDIT_ACTIVE", "Closed", {
        "AMT_CREDIT_SUM": ["sum", "mean"],
        "DAYS_ENDDATE_FACT": ["max", "mean"],
    }),
]

PREVIOUS_SPEC = {
    "AMT_ANNUITY": ["min", "max", "mean"],
    "AMT_APPLICATION": ["min", "max", "mean"],
    "AMT_CREDIT": ["min", "max", "mean"],
    "APP_CREDIT_RATIO": ["min", "max", "mean", "var"],
    "AMT_DOWN_PAYMENT": ["min", "max", "mean"],
    "AMT_GOODS_PRICE": ["min", "max", "mean"],
    "HOUR_APPR_PROCESS_START": ["min", "max", "mean"],
    "RATE_DOWN_PAYMENT": ["min", "max", "mean"],
    "DAYS_DECISION": ["min", "max", "mean"],
    "CNT_PAYMENT": ["max", "mean", "sum"],
    "DAYS_FIRST_DUE": ["min", "max", "mean"],
    "DAYS_LAST_DUE_1ST_VERSION": ["min", "max", "mean"],
    "DAYS_LAST_DUE": ["min", "max", "mean"],
    "DAYS_TERMINATION": ["min", "max", "mean"],
}
PREVIOUS_SUBSETS = [
    Subset("APPROVED", "NAME_CONTRACT_STATUS", "Approved", {
        "AMT_CREDIT": ["max", "mean"],
        "AMT_ANNUITY": ["max", "mean"],
        "CNT_PAYMENT": ["mean", "sum"],
    }),
    Subset("REFUSED", "NAME_CONTRACT_STATUS", "Refused", {
        "AMT_APPLICATION": ["max", "mean"],
        "AMT_CREDIT": ["max", "mean"],
    }),
]

POS_SPEC = {
    "MONTHS_BALANCE": ["max", "mean", "size"],
    "CNT_INSTALMENT": ["mean", "sum"],
    "CNT_INSTALMENT_FUTURE": ["mean", "sum"],
    "SK_DPD": ["max", "mean"],
    "SK_DPD_DEF": ["max", "mean"],
}

INSTALMENT_SPEC = {
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "DPD": ["max", "mean", "sum"],
    "DBD": ["max", "mean", "sum"],
    "PAYMENT_RATIO": ["min", "max", "mean", "var"],
    "PAYMENT_DIFF": ["min", "max", "mean", "sum"],
    "AMT_INSTALMENT": ["min", "max", "mean", "sum"],
    "AMT_PAYMENT": ["min", "max", "mean", "sum"],
    "DAYS_ENTRY_PAYMENT": ["min", "max", "mean"],
    "DAYS_INSTALMENT": ["min", "max", "mean"],
}

CARD_SPEC = {
    "MONTHS_BALANCE": ["min", "max", "mean", "size"],
    "AMT_BALANCE": ["min", "max", "mean", "sum"],
    "AMT_CREDIT_LIMIT_ACTUAL": ["max", "mean"],
    "AMT_DRAWINGS_ATM_CURRENT": ["max", "mean", "sum"],
    "AMT_DRAWINGS_CURRENT": ["max", "mean", "sum"],
    "AMT_DRAWINGS_OTHER_CURRENT": ["max", "mean", "sum"],
    "AMT_DRAWINGS_POS_CURRENT": ["max", "mean", "sum"],
    "AMT_INST_MIN_REGULARITY": ["max", "mean"],
    "AMT_PAYMENT_CURRENT": ["max", "mean", "sum"],
    "AMT_PAYMENT_TOTAL_CURRENT": ["max", "mean", "sum"],
    "AMT_RECEIVABLE_PRINCIPAL": ["max", "mean", "sum"],
    "AMT_RECIVABLE": ["max", "mean", "sum"],
    "AMT_TOTAL_RECEIVABLE": ["max", "mean", "sum"],
    "CNT_DRAWINGS_ATM_CURRENT": ["max", "mean", "sum"],
    "CNT_DRAWINGS_CURRENT": ["max", "mean", "sum"],
    "CNT_DRAWINGS_OTHER_CURRENT": ["max", "mean", "sum"],
    "CNT_DRAWINGS_POS_CURRENT": ["max", "mean", "sum"],
    "CNT_INSTALMENT_MATURE_CUM": ["max", "mean", "sum"],
    "SK_DPD": ["max", "mean"],
    "SK_DPD_DEF": ["max", "mean"],
}
# -----------------------------------------------------------------------------------------------

Levels = Mapping[str, Sequence[str]]


def _row_count(name: str):
    return F.count("*").cast("int").alias(name)


def balance_features(balance: DataFrame) -> DataFrame:
    """Monthly balances per loan."""
    return aggregate_by(balance, "SK_ID_BUREAU", prefix="BB", spec=BALANCE_SPEC)


def bureau_features(bureau: DataFrame, balance: DataFrame, levels: Levels | None = None) -> DataFrame:
    loans = bureau.join(balance_features(balance), "SK_ID_BUREAU", "left")
    return aggregate_by(
        loans, CLIENT_KEY, prefix="BURO", spec=BUREAU_SPEC, subsets=BUREAU_SUBSETS, levels=levels,
        extra=[_row_count("BURO_LOAN_COUNT")],
    )


def previous_features(previous: DataFrame, levels: Levels | None = None) -> DataFrame:
    return aggregate_by(
        clean_previous_applications(previous), CLIENT_KEY, prefix="PREV", spec=PREVIOUS_SPEC,
        subsets=PREVIOUS_SUBSETS, levels=levels, extra=[_row_count("PREV_APPLICATION_COUNT")],
    )


def pos_features(pos: DataFrame, levels: Levels | None = None) -> DataFrame:
    return aggregate_by(
        pos, CLIENT_KEY, prefix="POS", spec=POS_SPEC, levels=levels,
        extra=[_row_count("POS_CASH_COUNT")],
    )


def instalment_features(instalments: DataFrame) -> DataFrame:
    return aggregate_by(
        clean_instalments(instalments), CLIENT_KEY, prefix="INSTAL", spec=INSTALMENT_SPEC,
        extra=[_row_count("INSTALLMENTS_COUNT")],
    )


def card_features(cards: DataFrame, levels: Levels | None = None) -> DataFrame:
    features = aggregate_by(
        cards, CLIENT_KEY, prefix="CC", spec=CARD_SPEC, levels=levels,
        extra=[_row_count("CREDIT_CARD_LINE_COUNT")], distinct={"CREDIT_CARD_PREV_COUNT": "SK_ID_PREV"},
    )
    return features.withColumn("CREDIT_CARD_PREV_COUNT", F.col("CREDIT_CARD_PREV_COUNT").cast("int"))


def join_features(base: DataFrame, frames: Mapping[str, DataFrame], key: str = CLIENT_KEY) -> DataFrame:
    """Left-join every feature frame on the client key.

    Each frame is already hash-partitioned on the key by its own aggregation, and the running result
    keeps that partitioning, so only ``base`` is shuffled.
    """
    joined = base
    for frame in frames.values():
        joined = joined.join(frame, key, "left")
    return joined


def join_coverage(
    joined: DataFrame, frames: Mapping[str, DataFrame], *, key: str = CLIENT_KEY, target: str = "TARGET"
) -> DataFrame:
    """Per source: clients with any feature present, over all, labelled and unlabelled clients."""
    labelled = F.col(target).isNotNull()
    cells = []
    for source, frame in frames.items():
        columns = [c for c in frame.columns if c != key]
        matched = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(1)) for c in columns], F.lit(0))
        cells.append(
            F.struct(
                F.lit(source).alias("source"),
                F.lit(len(columns)).alias("feature_columns"),
                F.sum(matched).alias("matched_clients_all"),
                F.avg(matched).alias("coverage_ratio_all"),
                F.coalesce(F.sum(F.when(labelled, matched)), F.lit(0)).alias("matched_clients_train"),
                F.avg(F.when(labelled, matched)).alias("coverage_ratio_train"),
                F.coalesce(F.sum(F.when(~labelled, matched)), F.lit(0)).alias("matched_clients_test"),
                F.avg(F.when(~labelled, matched)).alias("coverage_ratio_test"),
            )
        )
    return joined.agg(F.array(*cells).alias("rows")).select(F.inline("rows"))
