"""Derived views over the given tables, in SQL both Spark and the checking engine read.

``{name}`` stands for a table. Amounts are whole numbers so that sums are exact in any order.
"""

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def _gap(expression: str, key: str, step: int) -> str:
    """``expression``, missing in every ``step``-th row of ``key``."""
    return f"CASE WHEN {key} % {step} = 0 THEN NULL ELSE {expression} END"


def _amount(column: str, divisor: int = 1) -> str:
    return f"CAST(floor({column} / {divisor}) AS DOUBLE)"


BUREAU = f"""
SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU,
       CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' ELSE 'Sold' END AS CREDIT_ACTIVE,
       CAST(-(o_orderkey % 2900) AS DOUBLE) AS DAYS_CREDIT,
       CAST(o_orderkey % 40 AS DOUBLE) AS CREDIT_DAY_OVERDUE,
       CAST({_gap("o_orderkey % 1700 - 800", "o_orderkey", 13)} AS DOUBLE) AS DAYS_CREDIT_ENDDATE,
       CAST({_gap("-(o_orderkey % 1300)", "o_orderkey", 3)} AS DOUBLE) AS DAYS_ENDDATE_FACT,
       {_gap(_amount("o_totalprice", 50), "o_orderkey", 4)} AS AMT_CREDIT_MAX_OVERDUE,
       CAST(o_orderkey % 5 AS DOUBLE) AS CNT_CREDIT_PROLONG,
       {_amount("o_totalprice")} AS AMT_CREDIT_SUM,
       {_gap(_amount("o_totalprice", 3), "o_orderkey", 5)} AS AMT_CREDIT_SUM_DEBT,
       {_gap(_amount("o_totalprice", 7), "o_orderkey", 2)} AS AMT_CREDIT_SUM_LIMIT,
       {_amount("o_totalprice", 900)} AS AMT_CREDIT_SUM_OVERDUE,
       CAST(-(o_orderkey % 700) AS DOUBLE) AS DAYS_CREDIT_UPDATE,
       {_gap(_amount("o_totalprice", 24), "o_orderkey", 6)} AS AMT_ANNUITY
FROM {{orders}}
"""

BUREAU_BALANCE = """
SELECT CASE WHEN l_orderkey % 9 = 0 THEN -l_orderkey ELSE l_orderkey END AS SK_ID_BUREAU,
       CAST(-l_linenumber AS DOUBLE) AS MONTHS_BALANCE, l_returnflag AS STATUS
FROM {lineitem}
"""

PREVIOUS = f"""
SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV,
       CASE o_orderstatus WHEN 'O' THEN 'Approved' WHEN 'F' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
       {_gap(_amount("o_totalprice", 24), "o_orderkey", 6)} AS AMT_ANNUITY,
       {_amount("o_totalprice")} AS AMT_APPLICATION,
       CASE WHEN o_orderkey % 17 = 0 THEN 0.0E0 ELSE {_amount("o_totalprice", 2)} END AS AMT_CREDIT,
       {_gap(_amount("o_totalprice", 10), "o_orderkey", 2)} AS AMT_DOWN_PAYMENT,
       {_amount("o_totalprice", 3)} AS AMT_GOODS_PRICE,
       CAST(o_orderkey % 24 AS DOUBLE) AS HOUR_APPR_PROCESS_START,
       CAST({_gap("o_orderkey % 9", "o_orderkey", 2)} AS DOUBLE) AS RATE_DOWN_PAYMENT,
       CAST(-(o_orderkey % 2500) AS DOUBLE) AS DAYS_DECISION,
       CAST({_gap("o_orderkey % 60", "o_orderkey", 8)} AS DOUBLE) AS CNT_PAYMENT,
       CAST(CASE WHEN o_orderkey % 3 = 0 THEN 365243 ELSE -(o_orderkey % 2000) END AS DOUBLE) AS DAYS_FIRST_DRAWING,
       CAST(CASE WHEN o_orderkey % 4 = 0 THEN 365243 ELSE -(o_orderkey % 1900) END AS DOUBLE) AS DAYS_FIRST_DUE,
       CAST(CASE WHEN o_orderkey % 5 = 0 THEN 365243 ELSE -(o_orderkey % 1800) END AS DOUBLE) AS DAYS_LAST_DUE_1ST_VERSION,
       CAST(CASE WHEN o_orderkey % 6 = 0 THEN 365243 ELSE -(o_orderkey % 1700) END AS DOUBLE) AS DAYS_LAST_DUE,
       CAST(CASE WHEN o_orderkey % 7 = 0 THEN 365243 ELSE -(o_orderkey % 1600) END AS DOUBLE) AS DAYS_TERMINATION
FROM {{orders}}
"""

POS = f"""
SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV,
       CASE l_returnflag WHEN 'R' THEN 'Completed' WHEN 'A' THEN 'Active' ELSE NULL END AS NAME_CONTRACT_STATUS,
       CAST(-l_linenumber AS DOUBLE) AS MONTHS_BALANCE,
       {_gap("l_quantity", "l_partkey", 7)} AS CNT_INSTALMENT,
       CAST(l_partkey % 12 AS DOUBLE) AS CNT_INSTALMENT_FUTURE,
       CAST(l_suppkey % 30 AS DOUBLE) AS SK_DPD,
       CAST(l_suppkey % 4 AS DOUBLE) AS SK_DPD_DEF
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
"""

INSTALMENTS = f"""
SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV,
       CAST(l_linenumber AS DOUBLE) AS NUM_INSTALMENT_VERSION,
       CAST(-(l_partkey % 900) AS DOUBLE) AS DAYS_INSTALMENT,
       CAST({_gap("-(l_partkey % 900) + l_suppkey % 20 - 10", "l_suppkey", 11)} AS DOUBLE) AS DAYS_ENTRY_PAYMENT,
       CASE WHEN l_partkey % 29 = 0 THEN 0.0E0 ELSE {_amount("l_extendedprice")} END AS AMT_INSTALMENT,
       {_gap(_amount("l_extendedprice", 2), "l_suppkey", 11)} AS AMT_PAYMENT
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
"""

CARDS = f"""
SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV,
       CASE l_linestatus WHEN 'O' THEN 'Active' ELSE 'Completed' END AS NAME_CONTRACT_STATUS,
       CAST(-l_linenumber AS DOUBLE) AS MONTHS_BALANCE,
       {_amount("l_extendedprice")} AS AMT_BALANCE,
       CAST(l_partkey % 1000 AS DOUBLE) AS AMT_CREDIT_LIMIT_ACTUAL,
       {_gap("CAST(l_partkey % 11 AS DOUBLE)", "l_partkey", 3)} AS AMT_DRAWINGS_ATM_CURRENT,
       CAST(l_partkey % 13 AS DOUBLE) AS AMT_DRAWINGS_CURRENT,
       {_gap("CAST(l_partkey % 17 AS DOUBLE)", "l_partkey", 5)} AS AMT_DRAWINGS_OTHER_CURRENT,
       CAST(l_partkey % 19 AS DOUBLE) AS AMT_DRAWINGS_POS_CURRENT,
       CAST(l_partkey % 23 AS DOUBLE) AS AMT_INST_MIN_REGULARITY,
       {_gap(_amount("l_extendedprice", 4), "l_suppkey", 6)} AS AMT_PAYMENT_CURRENT,
       {_amount("l_extendedprice", 5)} AS AMT_PAYMENT_TOTAL_CURRENT,
       {_amount("l_extendedprice", 6)} AS AMT_RECEIVABLE_PRINCIPAL,
       {_amount("l_extendedprice", 7)} AS AMT_RECIVABLE,
       {_amount("l_extendedprice", 8)} AS AMT_TOTAL_RECEIVABLE,
       CAST(l_suppkey % 3 AS DOUBLE) AS CNT_DRAWINGS_ATM_CURRENT,
       CAST(l_suppkey % 5 AS DOUBLE) AS CNT_DRAWINGS_CURRENT,
       CAST(l_suppkey % 7 AS DOUBLE) AS CNT_DRAWINGS_OTHER_CURRENT,
       CAST(l_suppkey % 9 AS DOUBLE) AS CNT_DRAWINGS_POS_CURRENT,
       {_gap("CAST(l_quantity AS DOUBLE)", "l_suppkey", 4)} AS CNT_INSTALMENT_MATURE_CUM,
       CAST(l_suppkey % 31 AS DOUBLE) AS SK_DPD,
       CAST(l_suppkey % 2 AS DOUBLE) AS SK_DPD_DEF
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
"""

APPLICATIONS = f"""
SELECT c_custkey AS SK_ID_CURR,
       CASE WHEN c_custkey % 5 = 0 THEN 365243 ELSE CAST(-(c_custkey % 9000) AS INT) END AS DAYS_EMPLOYED,
       CAST(-(7300 + c_custkey % 15000) AS INT) AS DAYS_BIRTH,
       CASE WHEN c_custkey % 50 = 0 THEN 'XNA' WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS CODE_GENDER,
       CAST(c_custkey % 4 AS INT) AS CNT_CHILDREN,
       c_acctbal AS AMT_CREDIT,
       CASE WHEN c_custkey % 7 = 0 THEN 0.0E0 ELSE CAST(20000 + c_custkey AS DOUBLE) END AS AMT_INCOME_TOTAL,
       {_gap("CAST(c_custkey % 300 AS DOUBLE)", "c_custkey", 9)} AS AMT_ANNUITY,
       c_acctbal * 0.5E0 AS AMT_GOODS_PRICE,
       CAST({_gap("c_custkey % 6", "c_custkey", 8)} AS DOUBLE) AS CNT_FAM_MEMBERS,
       {_gap("(c_custkey % 97) / 97.0E0", "c_custkey", 2)} AS EXT_SOURCE_1,
       {_gap("(c_custkey % 89) / 89.0E0", "c_custkey", 3)} AS EXT_SOURCE_2,
       {_gap("(c_custkey % 83) / 83.0E0", "c_custkey", 4)} AS EXT_SOURCE_3,
       CAST(c_custkey % 2 AS INT) AS FLAG_DOCUMENT_2,
       CAST({_gap("c_custkey % 3", "c_custkey", 10)} AS INT) AS FLAG_DOCUMENT_3,
       CAST(c_nationkey % 2 AS INT) AS FLAG_MOBIL,
       CAST(c_nationkey % 3 AS INT) AS FLAG_PHONE,
       CAST(c_nationkey % 5 AS INT) AS REG_CITY_NOT_LIVE_CITY,
       CAST(c_nationkey % 7 AS INT) AS REG_CITY_NOT_WORK_CITY
FROM {{customer}}
"""

REQUESTS = """
SELECT c_custkey AS SK_ID_CURR,
       CAST(c_custkey % 110 AS DOUBLE) AS AGE_YEARS,
       c_acctbal AS AMT_INCOME_TOTAL,
       CASE WHEN c_custkey % 21 = 0 THEN NULL ELSE c_acctbal + 500.0E0 END AS AMT_CREDIT,
       CAST(c_custkey % 6 - 1 AS INT) AS CNT_CHILDREN,
       CAST(c_custkey % 5 - 2 AS DOUBLE) AS CNT_FAM_MEMBERS,
       CAST(c_custkey % 27 AS INT) AS HOUR_APPR_PROCESS_START,
       CAST(c_nationkey % 5 AS INT) AS REGION_RATING_CLIENT,
       CAST(c_nationkey % 3 AS INT) AS FLAG_MOBIL,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal / 8000.0E0 END AS EXT_SOURCE_1
FROM {customer}
"""

CALLS = """
SELECT event_id AS id,
       CASE WHEN event_type = 'purchase' THEN '/predict' WHEN event_type = 'view' THEN NULL
            ELSE concat('/', event_type) END AS path,
       CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 422 ELSE 200 END AS status_code,
       CASE WHEN event_id % 37 = 0 THEN NULL ELSE value END AS latency_ms,
       props AS request_payload,
       CAST(ts AS TIMESTAMP) AS created_at
FROM {events}
"""

PREDICTIONS = """
SELECT event_id AS id, props AS request_payload, value / 512.0E0 AS default_probability,
       CASE WHEN value / 512.0E0 >= 0.125E0 THEN 'refused' WHEN event_type = 'view' THEN NULL ELSE 'approved' END
           AS credit_decision,
       value AS latency_ms, CAST(ts AS TIMESTAMP) AS created_at
FROM {events}
"""

GAPS = f"""
SELECT {_gap("o_orderkey", "o_orderkey", 1000)} AS o_orderkey, o_custkey,
       {_gap("o_orderstatus", "o_orderkey", 7)} AS o_orderstatus,
       {_gap("o_totalprice", "o_orderkey", 5)} AS o_totalprice,
       o_orderpriority
FROM {{orders}}
"""

LABELLED = """
SELECT CASE WHEN l_quantity + l_linenumber * 4 > 45 THEN 1 ELSE 0 END AS label,
       l_quantity, CAST(floor(l_extendedprice) AS DOUBLE) AS price,
       CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_discount END AS l_discount,
       1 AS constant_number,
       l_linestatus,
       CASE WHEN l_quantity < 10 THEN NULL WHEN l_quantity < 30 THEN 'medium_band' ELSE 'large_band' END AS band,
       concat('P', CAST(l_suppkey % 60 AS VARCHAR(10))) AS crowded,
       CASE WHEN l_linenumber > 5 THEN 'high' ELSE 'low' END AS priority
FROM {lineitem}
"""

SCORED = """
SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
       CASE WHEN l_returnflag = 'R' THEN (l_quantity + 14) / 64.0E0 ELSE l_quantity / 64.0E0 END AS score,
       l_linestatus, l_linenumber
FROM {lineitem}
"""

DECIDED = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS TARGET,
       CASE WHEN o_totalprice > 200000 + c_nationkey * 4000 THEN 1 ELSE 0 END AS prediction,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END AS segment,
       c_nationkey * 4 AS age
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

PERIODS = """
SELECT l_shipdate >= TIMESTAMP '1999-01-01 00:00:00' AS is_current,
       CASE WHEN l_shipdate >= TIMESTAMP '1999-01-01 00:00:00' THEN l_quantity * 1.25E0 ELSE l_quantity END AS quantity,
       CAST(floor(l_extendedprice) AS DOUBLE) AS price,
       CASE WHEN l_partkey % 10 = 0 OR (l_partkey % 4 = 0 AND l_shipdate >= TIMESTAMP '1999-01-01 00:00:00')
            THEN NULL ELSE l_tax END AS tax,
       CASE WHEN l_linenumber > 6 THEN 1 ELSE 0 END AS rare_flag,
       1 AS same_everywhere,
       CASE WHEN l_suppkey % 15 = 0 THEN NULL
            WHEN l_shipdate >= TIMESTAMP '1999-01-01 00:00:00' THEN l_returnflag ELSE l_linestatus END AS status,
       concat('S', CAST(l_suppkey % 35 AS VARCHAR(10))) AS source
FROM {lineitem}
"""
# The same with the time of each line.
TIMED_PERIODS = PERIODS.replace("SELECT ", "SELECT CAST(l_shipdate AS TIMESTAMP) AS created_at, ", 1)

# One row per candidate for the report views: every line number stands for a model, measures are its line sums.
_RESULT_MEASURES = [
    "threshold", "cv_business_cost", "cv_roc_auc", "cv_average_precision", "cv_accuracy", "cv_balanced_accuracy",
    "oof_roc_auc", "oof_average_precision", "oof_precision", "oof_recall", "oof_f1", "oof_accuracy",
    "oof_balanced_accuracy", "holdout_business_cost", "holdout_business_score", "holdout_roc_auc",
    "holdout_average_precision", "holdout_accuracy", "holdout_balanced_accuracy", "holdout_precision",
    "holdout_recall", "holdout_f1", "holdout_brier_score", "holdout_ks_statistic",
]
RESULTS = (
    "SELECT concat('model', CAST(l_linenumber AS STRING)) AS model_name, concat('base', CAST(l_linenumber % 3 AS STRING)) AS base_model_name, "
    "CASE WHEN l_linenumber % 2 = 0 THEN 'smote' ELSE 'baseline' END AS sampling_strategy, "
    "CASE WHEN l_linenumber = 1 THEN NULL ELSE concat('run', CAST(l_linenumber AS STRING)) END AS run_id, '{{}}' AS best_params, "
    + ", ".join(
        f"CAST(count(*) % {i + 11} AS DOUBLE) / {i + 11} AS {name}" for i, name in enumerate(_RESULT_MEASURES)
    )
    + ", count(*) AS true_negatives, count(*) + 1 AS false_positives, count(*) + 2 AS false_negatives, "
    "count(*) + 3 AS true_positives FROM {lineitem} GROUP BY l_linenumber"
)
