"""Fitted feature preparation: exact-median and mode imputation, one-hot encoding, optional scaling.

Imputation is a ``SQLTransformer`` whose statement carries the fitted values, so the whole preparation
is a plain, saveable ``PipelineModel`` of built-in stages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame

from riskloom.operators.cleaning import category_columns, numeric_columns
from riskloom.operators.explain import NUMERIC_SUFFIX, ONE_HOT_SUFFIX
from riskloom.operators.imputation import EMPTY_NUMBER, EMPTY_TEXT, medians, modes

TEXT_SUFFIX, INDEX_SUFFIX = "__text", "__index"


def imputation_stage(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> SQLTransformer:
    """Median for numbers, most frequent value for categories, fitted on ``df``."""
    middle = {r["column"]: r["median"] for r in medians(df, numeric).collect()} if numeric else {}
    common = {r["column"]: r["mode"] for r in modes(df, categorical).collect()} if categorical else {}
    cells = []
    for c in numeric:
        fill = middle.get(c)
        fill = EMPTY_NUMBER if fill is None else fill
        cells.append(f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {fill!r}D) AS `{c}{NUMERIC_SUFFIX}`")
    for c in categorical:
        text = str(common.get(c) or EMPTY_TEXT).replace("\\", "\\\\").replace("'", "\\'")
        cells.append(f"coalesce(CAST(`{c}` AS STRING), '{text}') AS `{c}{TEXT_SUFFIX}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(cells)} FROM __THIS__")


def fit_preparation(
    df: DataFrame,
    *,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    features: str = "features",
    scale: bool = False,
) -> PipelineModel:
    """Preparation fitted on ``df``. A category not seen here becomes an all-zero one-hot vector."""
    numeric = list(numeric_columns(df) if numeric is None else numeric)
    categorical = list(category_columns(df) if categorical is None else categorical)
    stages = [imputation_stage(df, numeric, categorical)]
    encoded = [f"{c}{ONE_HOT_SUFFIX}" for c in categorical]
    if categorical:
        indexed = [f"{c}{INDEX_SUFFIX}" for c in categorical]
        # "keep" adds one slot for unseen values and dropLast removes exactly that slot.
        stages += [
            StringIndexer(inputCols=[f"{c}{TEXT_SUFFIX}" for c in categorical], outputCols=indexed,
                          handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        ]
    stages.append(
        VectorAssembler(inputCols=[*(f"{c}{NUMERIC_SUFFIX}" for c in numeric), *encoded], outputCol="assembled")
    )
    if scale:
        stages.append(StandardScaler(inputCol="assembled", outputCol=features, withMean=False, withStd=True))
    else:
        stages.append(SQLTransformer(statement=f"SELECT *, assembled AS {features} FROM __THIS__"))
    return Pipeline(stages=stages).fit(df)
