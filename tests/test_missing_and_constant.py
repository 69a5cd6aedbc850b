"""NaN counts as missing, constant references are stable, correlations are pairwise at any width, OOT rows are the real ones."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.functions.exprs import psi_label
from riskframe.operators.drift import calculate_psi, variable_psi
from riskframe.operators.impute import fit_imputer, impute
from riskframe.operators.models import ModelSpec, fit_model
from riskframe.operators.quality import missing_rates
from riskframe.operators.selection import correlation_matrix


def test_nan_is_missing_in_fit_apply_and_rates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (math.nan,), (None,)], "x double")
    state = fit_imputer(df)
    assert state.numeric == {"x": 2.0}
    assert sorted(r.x for r in impute(df, state).collect()) == [1.0, 2.0, 2.0, 2.0, 4.0]
    assert fit_imputer(df.filter("x is not null")).numeric == {"x": 2.0}
    assert missing_rates(df).first()["missing_rate"] == pytest.approx(0.4)


def test_constant_reference_is_stable(spark):
    const = spark.createDataFrame([(1.0, 5.0), (1.0, 6.0), (1.0, 7.0)], "a double, b double")
    other = spark.createDataFrame([(2.0, 5.0), (3.0, 6.0)], "a double, b double")
    r = calculate_psi(const, other, "a").first()
    assert (r.psi, r.interpretation) == (0.0, "stable")
    rows = {x.variable: (x.psi, x.interpretation) for x in variable_psi(const, other, ["a", "b"]).collect()}
    assert rows["a"] == (0.0, "stable") and set(rows) == {"a", "b"}
    null = spark.range(1).select(psi_label(F.lit(None).cast("double")).alias("l")).first()
    assert null.l is None


@pytest.mark.parametrize("p", [12, 41])
def test_pairwise_correlation_with_gaps_at_any_width(spark, p):
    rng = np.random.default_rng(p)
    x = rng.normal(size=(60, p)) + rng.normal(size=(60, 1))
    x[rng.random((60, p)) < 0.2] = np.nan
    names = [f"c{i}" for i in range(p)]
    df = spark.createDataFrame([tuple(None if math.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{n} double" for n in names))
    assert np.allclose(correlation_matrix(df, names), pd.DataFrame(x).corr().to_numpy(), atol=1e-9)


def test_spearman_with_gaps_uses_each_pairs_complete_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 9, (40, 3)).astype(float)
    x[rng.random((40, 3)) < 0.2] = np.nan
    df = spark.createDataFrame([tuple(None if math.isnan(v) else float(v) for v in r) for r in x], "a double, b double, c double")
    assert np.allclose(correlation_matrix(df, ["a", "b", "c"], "spearman"), pd.DataFrame(x).corr("spearman").to_numpy(), atol=1e-9)


def test_training_on_missing_features_raises(spark):
    df = spark.createDataFrame([(i, float(i % 7) if i % 2 else None, i % 3 % 2) for i in range(60)], "k long, x double, y int")
    with pytest.raises(Exception):
        fit_model(df, ["x"], "y", ModelSpec("logreg"), calibrate=False, keys=["k"])


def test_out_of_time_rows_are_the_configured_ones(spark):
    from riskframe.config import RiskConfig
    from riskframe.plans.training_run import prepare_and_impute, run_training
    from riskframe.sources.tables import LOAN_KEY, loans_with_gaps
    df = loans_with_gaps(spark, "/root/testdata/sf0.001").drop("split", "p")
    cfg = RiskConfig(target="y", date_column="l_shipdate", split_date="1999-01-01", oot_start="2000-07-01", models=["logreg"])
    ready = prepare_and_impute(df, cfg, LOAN_KEY)
    n_oot = df.where("l_shipdate >= timestamp_ntz '2000-07-01' or l_shipdate is null").count()
    assert ready.oot.count() == n_oot > 0 and ready.oot.where("l_discount is null").count() == 0
    assert ready.checks.where("check = 'target_values'").first()["passed"]
    res = run_training(spark, df, cfg, LOAN_KEY)
    n = {r.comparison: r.n_actual for r in res.psi_detail.collect()}
    assert n["score_psi_oot_vs_test"] == n_oot != n["score_psi_test_vs_train"]
    assert "oot" in {r.section for r in res.report.select("section").distinct().collect()}


def test_edges_of_tiny_features_stay_inside_their_range():
    from riskframe.operators.binning import dedupe_edges
    assert dedupe_edges([1e-10, 3e-10, 5.5e-10, 9e-10]) == [1e-10, 3e-10, 5.5e-10, 9e-10]
    assert dedupe_edges([0.5, 0.50000000001, 0.5, 0.9]) == [0.5, 0.50000000001, 0.9]
