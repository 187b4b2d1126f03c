"""Per-column fill values and value repair."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import nan_to_null, number
from riskloom.operators.cleaning import category_columns, drop_non_features, numeric_columns, present
from riskloom.operators.profiling import level_counts
from riskloom.operators.ranking import exact_quantiles

# ---- Fixed values -----------------------------------------------------------------------------
EMPTY_NUMBER, EMPTY_TEXT = 0.0, "missing"
BINARY_FLAGS = [
    "FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL",
    *[f"FLAG_DOCUMENT_{i}" for i in range(2, 22)],
    "REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION",
    "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "LIVE_CITY_NOT_WORK_CITY", "DAYS_EMPLOYED_ANOM",
]
UNIT_INTERVALS = [
    "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "EXT_SOURCES_MEAN", "EXT_SOURCES_MIN", "EXT_SOURCES_MAX",
]
# -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Repair:
    """Keep a value satisfying ``accept`` (SQL over ``x``), otherwise use ``default``."""

    column: str
    accept: str
    default: float


# ---- Fixed values: accepted ranges and replacement values ---------------------------------------
REPAIRS = [
    Repair("AMT_INCOME_TOTAL", "x > 0", 50_000.0),
    Repair("AMT_CREDIT", "x > 0", 200_000.0),
    Repair("AGE_YEARS", "x >= 18 AND x < 100", 35.0),
    Repair("CNT_CHILDREN", "x >= 0", 0),
    Repair("CNT_FAM_MEMBERS", "x >= 0", 1.0),
    Repair("EXT_SOURCES_NA_COUNT", "x BETWEEN 0 AND 3", 0),
    Repair("HOUR_APPR_PROCESS_START", "x BETWEEN 0 AND 23", 12),
    Repair("REGION_RATING_CLIENT", "x BETWEEN 1 AND 3", 2),
    Repair("REGION_RATING_CLIENT_W_CITY", "x BETWEEN 1 AND 3", 2),
]
# -----------------------------------------------------------------------------------------------


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, median): exact medians over finite values."""
    finite = [_finite(F.col(c).cast("double")).alias(c) for c in columns]
    long = df.unpivot([], finite, "column", "value")
    return exact_quantiles(long, value="value", keys=["column"], quantiles={"median": 0.5})


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mode): most frequent value, ties to the smallest."""
    counts = level_counts(df, columns).filter("value IS NOT NULL")
    best = F.min(F.struct((-F.col("n")).alias("rank"), "value"))
    return counts.groupBy("column").agg(best["value"].alias("mode"))


def _finite(value: Column) -> Column:
    clean = F.nanvl(value, F.lit(None))
    return F.when(F.abs(clean) < float("inf"), clean)


def fill_values(df: DataFrame) -> dict[str, object]:
    """Fill value per column: exact median, mode or False. One value per column reaches the driver."""
    numbers = numeric_columns(df)
    texts = category_columns(df, booleans=False)
    booleans = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)]
    found: dict[str, object] = {c: EMPTY_NUMBER for c in numbers}
    found |= {c: EMPTY_TEXT for c in texts} | {c: False for c in booleans}
    if numbers:
        found |= {r["column"]: r["median"] for r in medians(df, numbers).collect()}
    if texts:
        found |= {r["column"]: r["mode"] for r in modes(df, texts).collect()}
    return found


def impute(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULL, NaN and infinite values; integer columns widen to double when the fill is fractional."""
    columns = {}
    for column, value in values.items():
        kind = df.schema[column].dataType
        base = F.col(column)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            base = _finite(base)
        elif isinstance(kind, T.IntegralType) and float(value).is_integer():
            value = int(value)
        columns[column] = F.coalesce(base, F.lit(value))
    return df.withColumns(columns) if columns else df


def repair_ranges(df: DataFrame, repairs: Sequence[Repair] = tuple(REPAIRS)) -> DataFrame:
    """Out-of-range values take their default; flags become 0/1; unit-interval columns are clipped."""
    fixed = {}
    for rule in (r for r in repairs if r.column in df.columns):
        value = number(rule.column)
        accepted = F.expr(re.sub(r"\bx\b", f"try_cast(`{rule.column}` AS DOUBLE)", rule.accept))
        fixed[rule.column] = F.when(accepted & value.isNotNull(), value).otherwise(F.lit(float(rule.default)))
    for column in present(df, BINARY_FLAGS):
        fixed[column] = (F.coalesce(number(column), F.lit(0.0)) >= 0.5).cast("int")
    for column in present(df, UNIT_INTERVALS):
        value = number(column)
        clipped = F.when(value < 0, 0.0).when(value > 1, 1.0).otherwise(value)
        fixed[column] = F.coalesce(clipped, F.lit(0.0))
    return df.withColumns(fixed) if fixed else df


def replay_frame(df: DataFrame) -> DataFrame:
    """Feature rows that pass validation: identifiers dropped, gaps filled, ranges repaired."""
    features = nan_to_null(drop_non_features(df))
    return repair_ranges(impute(features, fill_values(features)))
