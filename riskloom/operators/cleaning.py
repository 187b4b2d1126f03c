"""Row-level cleaning and features; every function is one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import (
    average_available,
    best_of,
    clip_low,
    nan_to_null,
    null_if,
    safe_ratio,
    spread_available,
    sum_available,
)

# ---- Fixed values -----------------------------------------------------------------------------
DAYS_SENTINEL = 365243
DAYS_PER_YEAR = 365.25
GENDER_PLACEHOLDER = "XNA"
PREVIOUS_DAY_COLUMNS = [
    "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION",
]
EXT_SOURCES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
PHONE_FLAGS = [
    "FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL",
]
ADDRESS_MISMATCHES = [
    "REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION",
    "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "LIVE_CITY_NOT_WORK_CITY",
]
DOCUMENT_PREFIX = "FLAG_DOCUMENT_"
# name: (numerator, denominator)
APPLICATION_RATIOS = {
    "CREDIT_TO_INCOME_RATIO": ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
    "ANNUITY_TO_INCOME_RATIO": ("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    "CREDIT_TO_ANNUITY_RATIO": ("AMT_CREDIT", "AMT_ANNUITY"),
    "GOODS_TO_CREDIT_RATIO": ("AMT_GOODS_PRICE", "AMT_CREDIT"),
    "INCOME_PER_PERSON": ("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
    "ANNUITY_PER_PERSON": ("AMT_ANNUITY", "CNT_FAM_MEMBERS"),
    "CHILDREN_RATIO": ("CNT_CHILDREN", "CNT_FAM_MEMBERS"),
}
PREVIOUS_RATIOS = {
    "APP_CREDIT_RATIO": ("AMT_APPLICATION", "AMT_CREDIT"),
    "DOWN_PAYMENT_RATIO": ("AMT_DOWN_PAYMENT", "AMT_CREDIT"),
    "GOODS_CREDIT_RATIO": ("AMT_GOODS_PRICE", "AMT_CREDIT"),
}
INSTALMENT_RATIOS = {
    "PAYMENT_RATIO": ("AMT_PAYMENT", "AMT_INSTALMENT"),
}
# -----------------------------------------------------------------------------------------------


def present(df: DataFrame, columns: Sequence[str] = (), *, prefix: str | None = None) -> list[str]:
    """Columns of ``df`` among ``columns``, or all that start with ``prefix``."""
    if prefix is not None:
        return [c for c in df.columns if c.startswith(prefix)]
    return [c for c in columns if c in df.columns]


def ratio_columns(ratios: Mapping[str, tuple[str, str]]) -> dict[str, Column]:
    return {name: safe_ratio(numerator, denominator) for name, (numerator, denominator) in ratios.items()}


def sentinel_to_null(df: DataFrame, columns: Sequence[str], sentinel: float = DAYS_SENTINEL) -> DataFrame:
    found = present(df, columns)
    return df.withColumns({c: null_if(c, sentinel) for c in found}) if found else df


def clean_applications(df: DataFrame) -> DataFrame:
    """Sentinel and placeholder clean-up plus all row-level application features."""
    base = nan_to_null(df).withColumns(
        {
            "DAYS_EMPLOYED_ANOM": F.coalesce((F.col("DAYS_EMPLOYED") == DAYS_SENTINEL).cast("int"), F.lit(0)),
            "DAYS_EMPLOYED": null_if("DAYS_EMPLOYED", DAYS_SENTINEL),
            "CODE_GENDER": null_if("CODE_GENDER", GENDER_PLACEHOLDER),
        }
    )
    derived = {
        "AGE_YEARS": -F.col("DAYS_BIRTH") / F.lit(DAYS_PER_YEAR),
        "EMPLOYED_YEARS": -F.col("DAYS_EMPLOYED") / F.lit(DAYS_PER_YEAR),
        "EMPLOYED_TO_AGE_RATIO": safe_ratio(F.abs("DAYS_EMPLOYED"), F.abs("DAYS_BIRTH")),
        **ratio_columns(APPLICATION_RATIOS),
    }
    sources = present(base, EXT_SOURCES)
    if sources:
        derived |= {
            "EXT_SOURCES_MEAN": average_available(sources),
            "EXT_SOURCES_STD": spread_available(sources),
            "EXT_SOURCES_MIN": best_of(sources, largest=False),
            "EXT_SOURCES_MAX": best_of(sources, largest=True),
            "EXT_SOURCES_NA_COUNT": sum_available([F.col(c).isNull().cast("int") for c in sources]),
        }
    for name, columns in {
        "DOCUMENT_COUNT": present(base, prefix=DOCUMENT_PREFIX),
        "PHONE_FLAG_COUNT": present(base, PHONE_FLAGS),
        "ADDRESS_MISMATCH_COUNT": present(base, ADDRESS_MISMATCHES),
    }.items():
        if columns:
            derived[name] = sum_available(columns)
    return base.withColumns(derived)


def clean_previous_applications(df: DataFrame) -> DataFrame:
    return sentinel_to_null(nan_to_null(df), PREVIOUS_DAY_COLUMNS).withColumns(ratio_columns(PREVIOUS_RATIOS))


def clean_instalments(df: DataFrame) -> DataFrame:
    delay = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    return nan_to_null(df).withColumns(
        {
            **ratio_columns(INSTALMENT_RATIOS),
            "PAYMENT_DIFF": F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT"),
            "DPD": clip_low(delay),
            "DBD": clip_low(-delay),
        }
    )


def numeric_columns(df: DataFrame, *, booleans: bool = False) -> list[str]:
    kinds = (T.NumericType, T.BooleanType) if booleans else (T.NumericType,)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def category_columns(df: DataFrame, *, booleans: bool = True) -> list[str]:
    kinds = (T.StringType, T.BooleanType) if booleans else (T.StringType,)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def split_features_target(
    df: DataFrame, *, target: str, drop_columns: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    dropped = [c for c in dict.fromkeys(drop_columns) if c != target]
    absent = [c for c in [target, *dropped] if c not in df.columns]
    if absent:
        raise ValueError(f"Missing required columns: {absent}")
    return df.drop(target, *dropped), df.select(target)


def drop_non_features(df: DataFrame, *, target: str = "TARGET", id_column: str = "SK_ID_CURR") -> DataFrame:
    return df.drop(target, id_column)


def with_missing_label(df: DataFrame, target: str = "TARGET") -> DataFrame:
    return df.withColumn(target, F.lit(None).cast("double"))


def union_train_test(train: DataFrame, test: DataFrame, *, target: str = "TARGET") -> DataFrame:
    labelled = train.withColumn(target, F.col(target).cast("double"))
    return labelled.unionByName(test.drop(target), allowMissingColumns=True)


def split_by_label(df: DataFrame, *, target: str = "TARGET") -> tuple[DataFrame, DataFrame]:
    labelled = df.filter(F.col(target).isNotNull()).withColumn(target, F.col(target).cast("int"))
    return labelled, df.filter(F.col(target).isNull()).drop(target)


def conform(df: DataFrame, schema: T.StructType, *, lenient: bool = False) -> DataFrame:
    """Cast columns to a declared schema, leaving text as it is."""

    def cast(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            return column
        kind = field.dataType
        return (column.try_cast(kind) if lenient else column.cast(kind)).alias(field.name)

    return df.select(*[cast(f) for f in schema])


def align_columns(reference: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames on their shared columns, in reference order."""
    shared = [c for c in reference.columns if c in set(current.columns)]
    return reference.select(*shared), current.select(*shared)


def narrow_types(df: DataFrame) -> DataFrame:
    """Smallest lossless numeric types for the sink; one aggregate decides all columns."""
    integral = [f.name for f in df.schema if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType))]
    floating = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    if not integral and not floating:
        return df
    probes = []
    for c in integral:
        probes += [F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi")]
    for c in floating:
        probes.append(
            F.coalesce(F.bool_and(F.col(c).cast("float").cast("double") == F.col(c)), F.lit(False)).alias(f"{c}__f")
        )
    seen = df.agg(*probes).first().asDict()

    def smallest(column: str) -> str | None:
        low, high = seen[f"{column}__lo"], seen[f"{column}__hi"]
        if low is None:
            return None
        for kind, bits in (("tinyint", 7), ("smallint", 15), ("int", 31)):
            if -(2**bits) <= low and high < 2**bits:
                return kind
        return None

    casts = {c: F.col(c).cast(kind) for c in integral if (kind := smallest(c))}
    casts |= {c: F.col(c).cast("float") for c in floating if seen[f"{c}__f"]}
    return df.withColumns(casts) if casts else df
