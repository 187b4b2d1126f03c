"""Table contracts: raw client/loan tables, production logs, prediction tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- Fixed values: raw tables, their keys and their categorical columns -----------------------
RAW_TABLE_KEYS = {
    "application_train.csv": ["SK_ID_CURR", "TARGET"],
    "application_test.csv": ["SK_ID_CURR"],
    "bureau.csv": ["SK_ID_CURR", "SK_ID_BUREAU"],
    "bureau_balance.csv": ["SK_ID_BUREAU"],
    "previous_application.csv": ["SK_ID_CURR", "SK_ID_PREV"],
    "POS_CASH_balance.csv": ["SK_ID_CURR", "SK_ID_PREV"],
    "credit_card_balance.csv": ["SK_ID_CURR", "SK_ID_PREV"],
    "installments_payments.csv": ["SK_ID_CURR", "SK_ID_PREV"],
}

RAW_CATEGORICAL = {
    "application": [
        "NAME_CONTRACT_TYPE", "CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY", "NAME_TYPE_SUITE",
        "NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE",
        "OCCUPATION_TYPE", "WEEKDAY_APPR_PROCESS_START", "ORGANIZATION_TYPE", "FONDKAPREMONT_MODE",
        "HOUSETYPE_MODE", "WALLSMATERIAL_MODE", "EMERGENCYSTATE_MODE",
    ],
    "bureau": ["CREDIT_ACTIVE", "CREDIT_CURRENCY", "CREDIT_TYPE"],
    "bureau_balance": ["STATUS"],
    "previous_application": [
        "NAME_CONTRACT_TYPE", "WEEKDAY_APPR_PROCESS_START", "FLAG_LAST_APPL_PER_CONTRACT",
        "NAME_CASH_LOAN_PURPOSE", "NAME_CONTRACT_STATUS", "NAME_PAYMENT_TYPE", "CODE_REJECT_REASON",
        "NAME_TYPE_SUITE", "NAME_CLIENT_TYPE", "NAME_GOODS_CATEGORY", "NAME_PORTFOLIO", "NAME_PRODUCT_TYPE",
        "CHANNEL_TYPE", "NAME_SELLER_INDUSTRY", "NAME_YIELD_GROUP", "PRODUCT_COMBINATION",
    ],
    "POS_CASH_balance": ["NAME_CONTRACT_STATUS"],
    "installments_payments": [],
    "credit_card_balance": ["NAME_CONTRACT_STATUS"],
}

# Tokens read as a missing cell in delimited text.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# ---- Fixed values: production log tables ------------------------------------------------------
LOG_SCHEMAS = {
    "prediction_logs": """id STRING, request_payload STRING, response_payload STRING,
        default_probability DOUBLE, credit_decision STRING, latency_ms DOUBLE, created_at TIMESTAMP""",
    "production_inputs": """id STRING, prediction_log_id STRING, input_payload STRING,
        feature_count INT, created_at TIMESTAMP""",
    "production_outputs": """id STRING, prediction_log_id STRING, output_payload STRING,
        default_probability DOUBLE, business_threshold DOUBLE, predicted_default INT,
        credit_decision STRING, latency_ms DOUBLE, created_at TIMESTAMP""",
    "api_call_logs": """id STRING, method STRING, path STRING, status_code INT, latency_ms DOUBLE,
        request_payload STRING, error_type STRING, error_message STRING, client_host STRING,
        user_agent STRING, created_at TIMESTAMP""",
}

PREDICTION_SCHEMA = "SK_ID_CURR BIGINT, TARGET INT, probability DOUBLE, prediction INT"
RESPONSE_SCHEMA = (
    "default_probability DOUBLE, business_threshold DOUBLE, predicted_default INT, credit_decision STRING"
)
# -----------------------------------------------------------------------------------------------


def log_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(LOG_SCHEMAS[table])


def categorical_columns(table: str) -> list[str]:
    stem = table.removesuffix(".csv")
    stem = "application" if stem.startswith("application_") else stem
    return list(RAW_CATEGORICAL.get(stem, []))


def raw_schema(table: str, header: list[str]) -> T.StructType:
    """Explicit schema for a raw table: keys are long, listed columns text, the rest double."""
    text = set(categorical_columns(table))

    def data_type(column: str) -> T.DataType:
        if column.startswith("SK_ID_"):
            return T.LongType()
        return T.StringType() if column in text else T.DoubleType()

    return T.StructType([T.StructField(c, data_type(c), True) for c in header])
