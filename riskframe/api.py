"""Public names of the reference, with DataFrame signatures.

A user of the single-machine library finds each function here under the same name;
arguments that were arrays are column names of one DataFrame, results that were
dicts/frames are Spark DataFrames (one row for scalar bundles). Every function
delegates to the Spark operators in ``riskframe.operators``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.config import RiskConfig
from riskframe.functions.exprs import psi_label
from riskframe.operators import attribution as _attr
from riskframe.operators import calibration as _cal
from riskframe.operators import cleaning as _clean
from riskframe.operators import curves as _curves
from riskframe.operators import decisions as _dec
from riskframe.operators import drift as _drift
from riskframe.operators import impute as _imp
from riskframe.operators import loss as _loss
from riskframe.operators import metrics as _met
from riskframe.operators import models as _models
from riskframe.operators import quality as _q
from riskframe.operators import reports as _rep
from riskframe.operators import selection as _sel
from riskframe.operators import split as _split
from riskframe.operators import woe as _woe
from riskframe.sources import io as _io

# ---- ingestion and preparation ----------------------------------------------------------
load_data = _io.load_data
save_processed = _io.save_table


def clean_application_train(df: DataFrame) -> DataFrame:
    return _clean.clean(df, _clean.APPLICATION_RULES)


def load_or_create_clean_data(spark: SparkSession, raw_path: str, clean_path: str, force_reload: bool = False) -> DataFrame:
    return _io.load_or_create_clean(spark, raw_path, clean_path, clean_application_train, force_reload)


check_for_leakage = _q.check_for_leakage
check_schema = _q.check_schema
check_target_values = _q.check_target_values
check_duplicate_records = _q.check_duplicates
check_missingness = _q.check_missingness
check_numeric_ranges = _q.check_numeric_ranges
check_categorical_values = _q.check_categorical_values
check_date_order = _q.check_date_order
check_period_overlap = _q.check_period_overlap
run_all_checks = _q.run_all_checks
time_based_split = _split.time_based_split


def impute_missing(df: DataFrame, imputer: _imp.ImputerState | None = None, fit: bool = False
                   ) -> tuple[DataFrame, _imp.ImputerState]:
    if fit:
        imputer = _imp.fit_imputer(df)
    elif imputer is None:
        raise ValueError("pass a fitted imputer or fit=True")
    return _imp.impute(df, imputer), imputer


def prepare_data(df: DataFrame, config: RiskConfig, keys: Sequence[str]):
    from riskframe.plans.training_run import prepare_data as _prep
    return _prep(df, config, keys)


# ---- encoding and selection --------------------------------------------------------------
WOEEncoder = _woe.WoeEncoder
fit_woe_encoder = _woe.fit_woe_encoder
calculate_iv = _sel.calculate_iv
select_by_iv = _sel.select_by_iv
calculate_vif = _sel.calculate_vif
prune_by_correlation = _sel.prune_by_correlation
prune_by_vif = _sel.prune_by_vif
select_features = _sel.select_features


# ---- models ------------------------------------------------------------------------------
def build_logreg(df: DataFrame, features: Sequence[str], target: str, C: float = 1.0, max_iter: int = 1000,
                 random_state: int = 42, calibrate: bool = True, keys: Sequence[str] | None = None):
    return _models.fit_model(df, features, target, _models.ModelSpec("logreg", C=C, max_iter=max_iter, seed=random_state),
                             calibrate=calibrate, keys=keys)


def build_rf(df: DataFrame, features: Sequence[str], target: str, n_estimators: int = 200, max_depth: int = 10,
             random_state: int = 42, calibrate: bool = True, keys: Sequence[str] | None = None):
    return _models.fit_model(df, features, target,
                             _models.ModelSpec("rf", n_trees=n_estimators, max_depth=max_depth, seed=random_state),
                             calibrate=calibrate, keys=keys)


def build_xgb(df: DataFrame, features: Sequence[str], target: str, n_estimators: int = 200, max_depth: int = 6,
              learning_rate: float = 0.1, subsample: float = 0.8, colsample_bytree: float = 0.8,
              random_state: int = 42, calibrate: bool = True, keys: Sequence[str] | None = None):
    """Boosted trees on MLlib GBT (column sampling per node, first-order gain)."""
    spec = _models.ModelSpec("gbt", n_trees=n_estimators, max_depth=max_depth, learning_rate=learning_rate,
                             subsample=subsample, colsample=colsample_bytree, seed=random_state)
    return _models.fit_model(df, features, target, spec, calibrate=calibrate, keys=keys)


def train_all_models(df: DataFrame, features: Sequence[str], config: RiskConfig, keys: Sequence[str]):
    from riskframe.plans.training_run import train_all_models as _train
    return _train(df, features, config, keys, names=("logreg", "rf", "gbt"))


def predict_proba(model: _models.CalibratedModel, df: DataFrame, out: str = "pd") -> DataFrame:
    return model.score(df, out=out)


def save_model(model: _models.CalibratedModel, path: str) -> None:
    model.save(path)


def load_model(spark: SparkSession, path: str) -> _models.CalibratedModel:
    return _models.CalibratedModel.load(spark, path)


def get_feature_importance(model: _models.CalibratedModel, spark: SparkSession) -> DataFrame:
    return model.feature_importance(spark)


# ---- evaluation --------------------------------------------------------------------------
def gini_from_auc(auc: Column | str) -> Column:
    return F.lit(2.0) * (F.col(auc) if isinstance(auc, str) else auc) - F.lit(1.0)


def ks_statistic(df: DataFrame, target: str, score: str) -> DataFrame:
    return _curves.ranking_metrics(df, target, score).select("ks")


def calculate_metrics(df: DataFrame, target: str, score: str, threshold: float = 0.5) -> DataFrame:
    return _met.evaluate_all(df, target, score, threshold=threshold).select("auc", "pr_auc", "gini", "ks", "brier", "f1")


reliability_curve = _cal.reliability_curve
calibration_metrics = _cal.calibration_metrics
evaluate_all = _met.evaluate_all
evaluate_at_thresholds = _met.threshold_table
compare_models = _met.compare_models
evaluate_cv = _models.evaluate_cv

# ---- decisions and loss ------------------------------------------------------------------
assign_risk_band = _dec.assign_risk_band
decision_metrics = _dec.decision_metrics
threshold_analysis = _met.threshold_table
find_optimal_threshold = _dec.find_optimal_threshold
segment_analysis = _dec.segment_analysis
expected_loss = _loss.expected_loss
portfolio_expected_loss = _loss.portfolio_expected_loss
expected_loss_by_band = _loss.expected_loss_by_band
sensitivity_analysis = _loss.sensitivity_analysis
el_with_assumptions = _loss.el_with_assumptions
el_by_decision = _loss.el_by_decision

# ---- monitoring --------------------------------------------------------------------------
calculate_psi = _drift.calculate_psi
calculate_variable_psi = _drift.variable_psi
generate_psi_report = _drift.drift_report
psi_report_buckets = _drift.psi_report


def psi_interpretation(psi: Column | str) -> Column:
    return psi_label(psi)


def calculate_psi_detailed(expected: DataFrame, actual: DataFrame, col: str, buckets: int = 10
                           ) -> tuple[DataFrame, DataFrame]:
    """(summary row with psi/interpretation/sizes, bucket rows)."""
    return _drift.calculate_psi_detailed(expected, actual, col, buckets)


def save_psi_report(report: DataFrame, path: str) -> None:
    _io.save_json_table(report, path)


def load_psi_report(spark: SparkSession, path: str) -> DataFrame:
    return _io.load_json_table(spark, path)


# ---- attribution and reports -------------------------------------------------------------
def generate_shap_explanations(model: _models.CalibratedModel, df: DataFrame, features: Sequence[str],
                               keys: Sequence[str], sample_size: int | None = 100, background: DataFrame | None = None,
                               n_permutations: int = 8) -> DataFrame:
    """Sampled-permutation Shapley values of the calibrated probability (long table)."""
    rows = _attr.hash_sample(df, keys, sample_size) if sample_size else df
    bg = background if background is not None else _attr.hash_sample(df, keys, 100, seed=7)
    return _attr.sampled_shapley(rows, bg, features, keys, lambda z: model.score(z, out="pd"),
                                 n_permutations=n_permutations)


pick_diverse_examples = _attr.pick_diverse_examples
compare_shap_with_logreg = _attr.rank_comparison
shap_dependence_data = _attr.dependence_data
global_shap_ranking = _attr.global_importance
generate_metrics_json = _rep.metrics_report
retrain_trigger = _rep.retrain_trigger


def save_metrics_report(report: DataFrame, path: str) -> None:
    _io.save_json_table(report, path)


def score_batch(df: DataFrame, encoder, model, low: float = 0.10, high: float = 0.30, keep: Sequence[str] = ()) -> DataFrame:
    """Encode, score, band and decide (the scoring core of the demo app)."""
    from riskframe.plans.scoring import score_batch as _score
    return _score(df, encoder, model, low, high, keep)


def scorecard(df: DataFrame, coefficients: dict[str, float], intercept: float, out: str = "pd") -> DataFrame:
    from riskframe.plans.scoring import scorecard as _sc
    return _sc(df, coefficients, intercept, out)
