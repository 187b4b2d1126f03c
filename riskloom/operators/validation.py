"""Row and request validation from rule tables; violations come back as an array of messages."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import nan_to_null
from riskloom.functions.payload import to_payload
from riskloom.operators.imputation import BINARY_FLAGS, UNIT_INTERVALS


@dataclass(frozen=True)
class Rule:
    """``accept`` is a SQL predicate over ``x``; NULL passes."""

    column: str
    accept: str
    message: str


@dataclass(frozen=True)
class RequestField:
    name: str
    kind: str  # double, float, int, bigint, boolean or string
    required: bool = True


# ---- Fixed values: accepted values and messages -----------------------------------------------
BUSINESS_RULES = [
    Rule("AGE_YEARS", "x >= 18 AND x < 100", "AGE_YEARS must be between 18 and 100."),
    Rule("AMT_INCOME_TOTAL", "x > 0", "AMT_INCOME_TOTAL must be strictly positive."),
    Rule("AMT_CREDIT", "x > 0", "AMT_CREDIT must be strictly positive."),
    Rule("CNT_CHILDREN", "x >= 0", "CNT_CHILDREN cannot be negative."),
    Rule("CNT_FAM_MEMBERS", "x >= 0", "CNT_FAM_MEMBERS cannot be negative."),
]
RANGE_RULES = [
    *[Rule(c, "x IN (0, 1)", f"{c} must be 0 or 1.") for c in BINARY_FLAGS],
    *[Rule(c, "x BETWEEN 0.0 AND 1.0", f"{c} must be between 0 and 1.") for c in UNIT_INTERVALS],
    Rule("EXT_SOURCES_NA_COUNT", "x BETWEEN 0 AND 3", "EXT_SOURCES_NA_COUNT must be between 0 and 3."),
    Rule("HOUR_APPR_PROCESS_START", "x BETWEEN 0 AND 23", "HOUR_APPR_PROCESS_START must be between 0 and 23."),
    Rule("REGION_RATING_CLIENT", "x BETWEEN 1 AND 3", "REGION_RATING_CLIENT must be between 1 and 3."),
    Rule("REGION_RATING_CLIENT_W_CITY", "x BETWEEN 1 AND 3", "REGION_RATING_CLIENT_W_CITY must be between 1 and 3."),
]
ALL_RULES = [*BUSINESS_RULES, *RANGE_RULES]
# -----------------------------------------------------------------------------------------------


def _broken(rule: Rule, value: str) -> Column:
    accepted = F.expr(re.sub(r"\bx\b", value, rule.accept))
    return F.when(~F.coalesce(accepted, F.lit(True)), F.lit(rule.message))


def _gather(checks: Sequence[Column]) -> Column:
    if not checks:
        return F.array().cast("array<string>")
    return F.filter(F.array(*checks), lambda m: m.isNotNull())


def row_violations(df: DataFrame, rules: Sequence[Rule] = tuple(ALL_RULES)) -> Column:
    """Messages of the broken rules; rules for absent columns are skipped."""
    return _gather([_broken(r, f"`{r.column}`") for r in rules if r.column in df.columns])


def validate_rows(df: DataFrame, rules: Sequence[Rule] = tuple(ALL_RULES)) -> DataFrame:
    return df.withColumn("violations", row_violations(df, rules))


def _typed_value(parsed: str, f: RequestField) -> Column:
    return F.try_variant_get(F.col(parsed), f"$['{f.name}']", f.kind)


def _type_check(parsed: str, f: RequestField) -> Column:
    """Message for a missing required field or a value that cannot be read as the declared type."""
    given = F.schema_of_variant(F.variant_get(F.col(parsed), f"$['{f.name}']", "variant"))
    absent = given.isNull() | (given == "VOID")
    if f.kind == "string":
        wrong = given != "STRING"
    elif f.kind in ("int", "bigint"):
        as_double = F.try_variant_get(F.col(parsed), f"$['{f.name}']", "double")
        wrong = as_double.isNull() | (as_double != F.floor(as_double)) | _typed_value(parsed, f).isNull()
    else:
        wrong = _typed_value(parsed, f).isNull()
    check = F.when(~absent & F.coalesce(wrong, F.lit(True)), F.lit(f"{f.name}: wrong type."))
    return F.when(absent, F.lit(f"{f.name}: field required.")).otherwise(check) if f.required else check


def parse_requests(
    df: DataFrame,
    fields: Sequence[RequestField],
    *,
    payload: str = "request_payload",
    rules: Sequence[Rule] = tuple(ALL_RULES),
) -> DataFrame:
    """Typed request columns plus ``violations`` for a table or stream of JSON requests."""
    parsed = df.withColumn("__v", F.try_parse_json(payload))
    is_object = F.coalesce(F.schema_of_variant("__v").startswith("OBJECT"), F.lit(False))
    typed = parsed.withColumns({f.name: _typed_value("__v", f) for f in fields})
    names = {f.name for f in fields}
    checks = [_type_check("__v", f) for f in fields]
    checks += [_broken(r, f"`{r.column}`") for r in rules if r.column in names]
    invalid = F.array(F.lit("payload: not a JSON object."))
    return typed.withColumn("violations", F.when(is_object, _gather(checks)).otherwise(invalid)).drop("__v")


def valid_payloads(df: DataFrame, *, drop: Sequence[str] = ("SK_ID_CURR", "TARGET")) -> DataFrame:
    """Rows as JSON request payloads."""
    features = [c for c in df.columns if c not in set(drop)]
    return nan_to_null(df).select(to_payload(features).alias("request_payload"))


def invalid_payloads(df: DataFrame, missing: str, *, drop: Sequence[str] = ("SK_ID_CURR", "TARGET")) -> DataFrame:
    """Payloads that lack one required field, for rejecting tests."""
    return valid_payloads(df, drop=[*drop, missing])
