"""Defaults of the composed jobs."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SplitConfig:
    # Default cutoffs.
    train_cutoff: str = "2024-06-30"
    val_cutoff: str = "2024-11-30"
    test_cutoff: str = "2025-04-30"
    force_balance: bool = True
    truncate_future: bool = False


@dataclass(frozen=True)
class TestConfig:
    kinds: tuple[str, ...] = ("chi_square", "ttest", "anova", "conversion", "correlation")
    corr_method: str = "pearson"
    min_corr: float = 0.05
    equal_var: bool = False
    min_rows: int = 30


@dataclass(frozen=True)
class ImportanceConfig:
    methods: tuple[str, ...] = ("attribution", "permutation")
    folds: int = 5
    top_k: int | None = None
    stability_threshold: float = 0.6
    filter_features: bool = True
    family: str = "lightgbm"
    params: dict = field(default_factory=dict)


@dataclass(frozen=True)
class TrainConfig:
    family: str = "lightgbm"
    params: dict = field(default_factory=dict)
    balance: str = "class_weight"  # or "oversample", "smote", "none"
    balance_below: float = 0.2
    ratio_pairs: bool = True
    # history, window counts, shares, frequencies and rare types; counted on the rows scored, so for batches only
    engineer: bool = False
    windows: tuple[int, ...] = (30, 90)
    channel: str | None = None
    record_type: str | None = None
    search_trials: int = 0  # cross-validated points of the family's grid; 0 takes ``params``
    search_pruner: str = "hyperband"  # or "median", "percentile", "none"; "grid" judges grid points on all rows
    search_timeout: float | None = None  # seconds after which no trial is started
    metric: str = "roc_auc"
    ensemble: tuple[str, ...] = ()  # families voted with weights found on validation
    select: bool = True
    calibrate: bool = True
    seed: int = 42
