"""Raw tables to one feature row per client, with profiles, coverage and quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators.aggregates import category_levels
from riskloom.operators.association import feature_target_associations, signed_associations
from riskloom.operators.cleaning import category_columns, clean_applications, split_by_label, union_train_test
from riskloom.operators.features import (
    bureau_features,
    card_features,
    instalment_features,
    join_coverage,
    join_features,
    pos_features,
    previous_features,
)
from riskloom.operators.profiling import (
    categorical_summary,
    dataset_metadata,
    drop_constant_columns,
    missingness_report,
    numeric_summary,
    schema_summary,
    stack_profiles,
    table_profile,
    target_correlations,
    target_distribution,
)
from riskloom.operators.sampling import random_sample, stratified_sample
from riskloom.session import materialize
from riskloom.settings import DatasetSettings
from riskloom.sources.tables import load_raw, sort_for_write, write_reports

CHILD_TABLES = [
    "bureau.csv", "bureau_balance.csv", "previous_application.csv", "POS_CASH_balance.csv",
    "installments_payments.csv", "credit_card_balance.csv",
]


@dataclass
class ClientDataset:
    train: DataFrame
    test: DataFrame
    reports: Mapping[str, DataFrame]
    dropped_columns: Sequence[str]


def client_features(
    applications: DataFrame, children: Mapping[str, DataFrame], levels: Mapping[str, Mapping] | None = None
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Cleaned applications with every child feature frame left-joined; also the frames themselves."""
    fitted = levels or {}
    frames = {
        "bureau": bureau_features(children["bureau.csv"], children["bureau_balance.csv"], fitted.get("bureau")),
        "previous_application": previous_features(
            children["previous_application.csv"], fitted.get("previous_application")
        ),
        "pos_cash": pos_features(children["POS_CASH_balance.csv"], fitted.get("pos_cash")),
        "installments": instalment_features(children["installments_payments.csv"]),
        "credit_card": card_features(children["credit_card_balance.csv"], fitted.get("credit_card")),
    }
    return join_features(clean_applications(applications), frames), frames


def fitted_levels(tables: Mapping[str, DataFrame]) -> dict[str, dict[str, list[str]]]:
    """Category levels of the child tables whose shares become columns; each list as long as its columns."""
    sources = {
        "bureau": "bureau.csv", "previous_application": "previous_application.csv", "pos_cash": "POS_CASH_balance.csv",
        "credit_card": "credit_card_balance.csv",
    }
    return {name: category_levels(tables[t], category_columns(tables[t])) for name, t in sources.items()}


def build_dataset(spark: SparkSession, folder: str, settings: DatasetSettings = DatasetSettings()) -> ClientDataset:
    loaded = {t: load_raw(spark, folder, t) for t in ["application_train.csv", "application_test.csv", *CHILD_TABLES]}
    tables = {name: df for name, (df, _) in loaded.items()}
    applications = union_train_test(
        tables["application_train.csv"], tables["application_test.csv"], target=settings.target
    )
    fitted = fitted_levels(tables)
    joined, frames = client_features(applications, {t: tables[t] for t in CHILD_TABLES}, fitted)
    wide = materialize(joined, "client-features")
    kept, dropped = drop_constant_columns(wide, excluded=[settings.id_column, settings.target])
    train, test = split_by_label(kept, target=settings.target)
    profiles = stack_profiles(
        [
            table_profile(df, name, duplicates_removed=removed.select("duplicates_removed").scalar())
            for name, (df, removed) in loaded.items()
        ]
    )
    reports = {
        "table_profiles": profiles,
        "merge_coverage": join_coverage(wide, frames, key=settings.id_column, target=settings.target),
        "train_missingness": missingness_report(train),
        "test_missingness": missingness_report(test),
        "dataset_metadata": dataset_metadata(kept, target=settings.target, constants=dropped),
    }
    return ClientDataset(train, test, reports, dropped)


def save_dataset(dataset: ClientDataset, folder: str, settings: DatasetSettings = DatasetSettings()) -> dict[str, str]:
    root = folder.rstrip("/")
    for name, df in {"train_features": dataset.train, "test_features": dataset.test}.items():
        sort_for_write(df, settings.id_column).write.mode("overwrite").parquet(f"{root}/{name}.parquet")
    return write_reports(dataset.reports, f"{root}/reports")


def quality_reports(
    df: DataFrame, *, target: str | None = None, ids: Sequence[str] = (), sample_size: int = 0, seed: int = 42
) -> dict[str, DataFrame]:
    """Profile tables of a feature table, on all rows or on an exact (stratified) sample."""
    view = df
    if sample_size > 0 and target and target in df.columns:
        view = stratified_sample(df, label=target, ids=ids, size=sample_size, seed=seed)
    elif sample_size > 0:
        view = random_sample(df, sample_size, ids=ids, seed=seed)
    reports = {
        "schema_summary": schema_summary(view),
        "numerical_summary": numeric_summary(view),
        "categorical_summary": categorical_summary(view),
        "missingness": missingness_report(view, with_coverage=True),
    }
    if target and target in df.columns:
        reports |= {
            "target_distribution": target_distribution(view, target),
            "target_correlations": target_correlations(view, target),
            "associations": feature_target_associations(view, target),
            "signed_associations": signed_associations(view, target),
        }
    return reports
