"""The end-to-end training/evaluation run (the reference's main entry point), as Spark jobs.

clean input -> split -> impute -> WOE -> IV/corr/VIF selection -> calibrated models ->
holdout metrics and model choice -> PSI -> decisions, thresholds, expected loss ->
optional attribution -> report tables and artefacts.

Every step is a lazy DataFrame or a bounded driver state (imputer values, bins, p x p
correlation, model coefficients). The WOE-encoded training frame, reused by IV,
correlation and every fit, is checkpointed to the shared checkpoint folder so a lost
executor recomputes from there, not from the raw scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.config import RiskConfig
from riskframe.functions.bins import linspace
from riskframe.operators.attribution import global_importance, linear_attribution, rank_comparison
from riskframe.operators.cleaning import feature_columns
from riskframe.operators.decisions import decision_metrics, find_optimal_threshold
from riskframe.operators.drift import calculate_psi, psi_report, variable_psi
from riskframe.operators.impute import ImputerState, fit_imputer, impute
from riskframe.operators.loss import el_with_assumptions
from riskframe.operators.metrics import compare_models, evaluate_all, threshold_table
from riskframe.operators.models import CalibratedModel, ModelSpec, fit_model, pick_best, score_all
from riskframe.operators.quality import run_all_checks
from riskframe.operators.reports import metrics_report
from riskframe.operators.selection import select_features
from riskframe.operators.split import split_label, stratified_split
from riskframe.operators.woe import WoeEncoder, WoeModel
from riskframe.session import ensure_checkpoint_dir, reliable_checkpoint


@dataclass
class RunResult:
    imputer: ImputerState
    encoder: WoeModel
    selected: list[str]
    iv_table: DataFrame
    models: dict[str, CalibratedModel]
    best_model: str
    test_metrics: DataFrame
    validation_metrics: DataFrame
    psi: DataFrame
    decision: DataFrame
    thresholds: DataFrame
    optimal: DataFrame
    expected_loss: DataFrame
    psi_detail: DataFrame
    variable_psi: DataFrame
    report: DataFrame
    attribution: DataFrame | None = None
    rank_comparison: DataFrame | None = None
    artifacts: dict[str, str] = field(default_factory=dict)
    checks: DataFrame | None = None


def model_spec(cfg: RiskConfig, name: str) -> ModelSpec:
    if name == "logreg":
        return ModelSpec("logreg", C=cfg.logreg_c, max_iter=cfg.logreg_max_iter, seed=cfg.random_state)
    if name == "rf":
        return ModelSpec("rf", n_trees=cfg.rf_n_estimators, max_depth=cfg.rf_max_depth, seed=cfg.random_state)
    if name == "gbt":
        return ModelSpec("gbt", n_trees=cfg.gbt_n_estimators, max_depth=cfg.gbt_max_depth,
                         learning_rate=cfg.gbt_learning_rate, subsample=cfg.gbt_subsample,
                         colsample=cfg.gbt_colsample, seed=cfg.random_state)
    raise ValueError(name)


def train_all_models(train: DataFrame, features: Sequence[str], cfg: RiskConfig, keys: Sequence[str],
                     names: Sequence[str] | None = None) -> dict[str, CalibratedModel]:
    """M6: the configured candidates, each a 3-fold isotonic ensemble."""
    return {n: fit_model(train, features, cfg.target, model_spec(cfg, n), calibrate=True, folds=cfg.cv_folds, keys=keys)
            for n in (names or cfg.models)}


def prepare_data(df: DataFrame, cfg: RiskConfig, keys: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """P10: time split when a split date is configured, else the stratified hash split."""
    if cfg.date_column and cfg.split_date:
        lab = split_label(df, cfg.date_column, cfg.split_date, cfg.oot_start, "__part")
        parts = [lab.where(F.col("__part") == p).drop("__part") for p in ("train", "test", "oot")]
        return parts[0], parts[1], parts[2] if cfg.oot_start else None
    lab = stratified_split(df, cfg.target, keys, cfg.test_size, cfg.random_state, out="__part", exact=cfg.exact_split)
    return (lab.where(F.col("__part") == "train").drop("__part"),
            lab.where(F.col("__part") == "test").drop("__part"), None)


@dataclass
class Prepared:
    """P10: parts with missing values filled by the imputer fitted on the training part, and the data checks."""

    train: DataFrame
    test: DataFrame
    oot: DataFrame | None
    imputer: ImputerState
    checks: DataFrame


def prepare_and_impute(df: DataFrame, cfg: RiskConfig, keys: Sequence[str], strict: bool = False) -> Prepared:
    """P10 in full: checks, split, imputer fitted on train and applied to every part.

    ``strict`` raises if a check fails; otherwise the check rows are part of the result."""
    checks = run_all_checks(df, cfg.target, cfg.date_column, cfg.forbidden_columns, strict=strict)
    train, test, oot = prepare_data(df, cfg, keys)
    feats = [c for c in feature_columns(df, cfg.target, cfg.date_column, cfg.forbidden_columns) if c not in keys]
    imputer = fit_imputer(train.select(*feats))
    return Prepared(impute(train, imputer), impute(test, imputer), None if oot is None else impute(oot, imputer), imputer, checks)


def run_training(spark: SparkSession, df: DataFrame, cfg: RiskConfig, keys: Sequence[str],
                 artifacts_dir: str | None = None) -> RunResult:
    target = cfg.target
    ready = prepare_and_impute(df, cfg, keys)
    train, test, oot, imputer = ready.train, ready.test, ready.oot, ready.imputer
    feats = [c for c in feature_columns(df, target, cfg.date_column, cfg.forbidden_columns) if c not in keys]

    encoder = WoeEncoder(cfg.n_bins, cfg.min_bin_size).fit(train.select(*feats, target), feats, target)
    train_woe = reliable_checkpoint(encoder.transform(train.select(*keys, *feats, target)))
    test_woe = encoder.transform(test.select(*keys, *feats, target))

    selected, iv = select_features(train_woe, target, feats, cfg.iv_min, cfg.iv_max, cfg.correlation_threshold,
                                   cfg.vif_threshold)
    if not selected:
        raise ValueError("No features selected. Check IV thresholds.")

    # Validation slice of min(5000, n/10) rows, cut by key hash within the training part.
    n_train = train_woe.count()
    val_frac = min(cfg.validation_max_rows, n_train // 10) / max(n_train, 1)
    lab = stratified_split(train_woe, target, keys, val_frac, cfg.random_state + 1, out="__v")
    fit_part, val_part = lab.where(F.col("__v") == "train").drop("__v"), lab.where(F.col("__v") == "test").drop("__v")

    models = train_all_models(fit_part, selected, cfg, keys)
    names = list(models)

    val_metrics = compare_models(score_all(val_part, models), target, names, n_bins=cfg.calibration_bins)
    test_scored = reliable_checkpoint(score_all(test_woe, models))
    test_metrics = compare_models(test_scored, target, names, n_bins=cfg.calibration_bins)
    best = pick_best(test_metrics, "model", names).first()["model"]

    train_scored = reliable_checkpoint(score_all(train_woe, {"score": models[best]}))
    test_best = test_scored.withColumn("score", F.col(best))
    psi = calculate_psi(train_scored, test_best, "score", cfg.psi_buckets, cfg.psi_bands)
    dec = decision_metrics(test_best, target, "score", cfg.low_threshold, cfg.high_threshold)
    thr = threshold_table(test_best, target, "score", linspace(0.01, 0.50, 50))
    opt = find_optimal_threshold(test_best, target, "score", cfg.optimal_objective, cfg.optimal_min_approval,
                                 cfg.optimal_max_bad_rate)
    el = el_with_assumptions(test_best, "score", cfg.ead_default, cfg.lgd_default)

    # Drift report: train vs test vs OOT; the test part doubles as OOT when none is configured.
    oot_best = test_best
    if oot is not None:
        oot_woe = encoder.transform(oot.select(*keys, *feats, target))
        oot_best = reliable_checkpoint(score_all(oot_woe, {"score": models[best]}))
    labelled = (train_scored.select("score", F.lit("train").alias("split"))
                .unionByName(test_best.select("score", F.lit("test").alias("split")))
                .unionByName(oot_best.select("score", F.lit("oot").alias("split"))))
    detail = psi_report(labelled, "score", "split", cfg.psi_buckets)
    var_psi = variable_psi(train_woe, test_woe, selected, cfg.psi_buckets, bands=cfg.psi_bands)

    attr = ranks = None
    if cfg.generate_attribution and "logreg" in models:
        lr = models["logreg"]
        import numpy as np
        coefs = list(np.mean([b.coefficients.toArray() for b in lr.bases], axis=0))
        attr = linear_attribution(test_woe, selected, coefs, keys, background=train_woe)
        ranks = rank_comparison(global_importance(attr), dict(zip(selected, coefs)))

    oot_metrics = {}
    if oot is not None:
        oot_metrics["oot"] = evaluate_all(oot_best, target, "score", n_bins=cfg.calibration_bins)
    report = metrics_report({**oot_metrics, "test": test_metrics.where(F.col("model") == best).drop("model"),
                             "validation": val_metrics.where(F.col("model") == best).drop("model"),
                             "psi": psi.select("psi"), "decision": dec, "expected_loss": el}, model=best)
    res = RunResult(imputer, encoder, selected, iv, models, best, test_metrics, val_metrics, psi, dec, thr, opt, el,
                    detail, var_psi, report, attr, ranks)
    res.checks = ready.checks
    if artifacts_dir is not None:
        res.artifacts = save_artifacts(res, artifacts_dir)
    return res


def save_artifacts(res: RunResult, root: str) -> dict[str, str]:
    """S3-S8 as one bundle, committed at once: report tables, thresholds as CSV, encoder bins and models through MLlib."""
    from riskframe.sources.bundle import write_bundle
    from riskframe.sources.io import save_json_table, save_table
    as_json = lambda df: lambda path: save_json_table(df, path)
    parts = {
        "metrics_report": as_json(res.report), "psi_report": as_json(res.psi_detail), "iv_table": as_json(res.iv_table),
        "variable_psi": as_json(res.variable_psi),
        "decision_thresholds": lambda path: save_table(res.thresholds.orderBy("threshold"), path, fmt="csv", single_file=True),
        "woe_encoder": res.encoder.save, "best_model": res.models[res.best_model].save,
    }
    if res.checks is not None:
        parts["data_checks"] = as_json(res.checks)
    bundle = write_bundle(res.report.sparkSession, root, parts)
    return {name: bundle.path(name) for name in parts}


def load_artifacts(spark: SparkSession, root: str) -> dict:
    """Everything batch scoring needs, from the newest committed bundle in ``root``."""
    from riskframe.sources.bundle import load_bundle
    from riskframe.sources.io import load_json_table
    bundle = load_bundle(spark, root)
    out = {"encoder": WoeModel.load(spark, bundle.path("woe_encoder")), "model": CalibratedModel.load(spark, bundle.path("best_model"))}
    tables = {"metrics": "metrics_report", "psi": "psi_report", "variable_psi": "variable_psi", "checks": "data_checks"}
    return out | {k: load_json_table(spark, bundle.path(part)) for k, part in tables.items() if part in bundle.parts}


def default_artifacts_dir(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/artifacts/{name}"
