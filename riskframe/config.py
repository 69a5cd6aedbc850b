"""Run parameters (the reference's YAML keys as a frozen dataclass)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class RiskConfig:
    # Defaults of the reference configuration.
    target: str = "TARGET"
    date_column: str | None = None
    split_date: str | None = None
    oot_start: str | None = None
    test_size: float = 0.2
    exact_split: bool = False   # exact per-class sizes (rank by key hash) instead of the share-based hash cut
    cv_folds: int = 3
    random_state: int = 42
    forbidden_columns: tuple[str, ...] = field(default_factory=tuple)
    n_bins: int = 10
    min_bin_size: float = 0.05
    iv_min: float = 0.02
    iv_max: float = 2.0
    correlation_threshold: float = 0.8
    vif_threshold: float = 10.0
    logreg_c: float = 1.0
    logreg_max_iter: int = 1000
    rf_n_estimators: int = 50
    rf_max_depth: int = 8
    gbt_n_estimators: int = 50
    gbt_max_depth: int = 4
    gbt_learning_rate: float = 0.1
    gbt_subsample: float = 0.8
    gbt_colsample: float = 0.8
    psi_buckets: int = 10
    calibration_bins: int = 10
    generate_attribution: bool = False
    low_threshold: float = 0.10
    high_threshold: float = 0.30
    ead_default: float = 10000.0
    lgd_default: float = 0.45
    psi_stable_threshold: float = 0.10
    psi_moderate_threshold: float = 0.25
    validation_max_rows: int = 5000
    models: tuple[str, ...] = ("logreg", "rf")
    optimal_objective: str = "balanced"
    optimal_min_approval: float = 0.1
    optimal_max_bad_rate: float = 0.2

    @property
    def psi_bands(self) -> list[tuple[float, str]]:
        """Limits of the PSI interpretation; from the last one on it is significant drift."""
        return [(self.psi_stable_threshold, "stable"), (self.psi_moderate_threshold, "moderate_shift")]
