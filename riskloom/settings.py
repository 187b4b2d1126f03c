"""Typed settings for the batch jobs; defaults are the fixed values of the analytics contract."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CostModel:
    fn_cost: float = 10.0
    fp_cost: float = 1.0
    grid_size: int = 401


@dataclass(frozen=True)
class DatasetSettings:
    target: str = "TARGET"
    id_column: str = "SK_ID_CURR"
    drop_columns: tuple[str, ...] = ("SK_ID_CURR",)
    holdout_fraction: float = 0.2
    seed: int = 42


@dataclass(frozen=True)
class DriftSettings:
    bins: int = 10
    min_current_rows: int = 30
    max_categories: int = 20


@dataclass(frozen=True)
class MonitoringSettings:
    latency_warning_ms: float = 1000.0
    error_rate_warning: float = 0.05
    drift: DriftSettings = field(default_factory=DriftSettings)


@dataclass(frozen=True)
class RebalanceSettings:
    oversampling_ratio: float = 0.3
    undersampling_ratio: float = 0.7
    neighbors: int = 5
    recall: float | None = None  # of the neighbour index; None: the exact join


@dataclass(frozen=True)
class ExperimentSettings:
    dataset: DatasetSettings = field(default_factory=DatasetSettings)
    cost: CostModel = field(default_factory=CostModel)
    rebalance: RebalanceSettings = field(default_factory=RebalanceSettings)
    folds: int = 5
    parallelism: int = 2
