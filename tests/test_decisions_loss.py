"""Bands, decision metrics, optimal threshold and expected loss."""

import numpy as np
import pandas as pd
import pytest

from riskframe.operators.decisions import (
    assign_decision, assign_risk_band, decision_metrics, find_optimal_threshold, segment_analysis,
)
from riskframe.operators.loss import (
    el_by_decision, el_with_assumptions, expected_loss_by_band, portfolio_expected_loss, sensitivity_analysis,
)


def _pdf(seed=0, n=2000):
    rng = np.random.default_rng(seed)
    p = np.round(rng.beta(2, 6, n), 3)
    y = (rng.random(n) < p).astype(int)
    return pd.DataFrame({"y": y, "p": p, "ead": np.round(rng.uniform(1000, 9000, n), 2),
                         "seg": rng.choice(["a", "b", None, "tiny"], n, p=[0.5, 0.45, 0.046, 0.004])})


def test_bands_edges_and_missing(spark):
    df = spark.createDataFrame([(0.0999,), (0.1,), (0.2999,), (0.3,), (None,)], "p double")
    assert [r["risk_band"] for r in assign_risk_band(df, "p").collect()] == ["Low", "Medium", "Medium", "High", "Medium"]


def test_decision_metrics_brute_force(spark):
    pdf = _pdf()
    r = decision_metrics(spark.createDataFrame(pdf), "y", "p").first()
    low, high = pdf.p < 0.1, pdf.p >= 0.3
    assert r["approval_rate"] + r["review_rate"] + r["decline_rate"] == pytest.approx(1.0)
    assert r["bad_rate_approved"] == pytest.approx(pdf.y[low].mean())
    assert r["default_capture_rate"] == pytest.approx(pdf.y[high].sum() / pdf.y.sum())
    assert r["false_decline_rate"] == pytest.approx(((pdf.y == 0) & high).sum() / (pdf.y == 0).sum())


def test_optimal_threshold_objectives(spark):
    pdf = _pdf(1)
    df = spark.createDataFrame(pdf)
    r = find_optimal_threshold(df, "y", "p", "max_approval", max_bad_rate=0.45).first()
    assert r["threshold"] is not None and r["bad_rate"] <= 0.45
    none = find_optimal_threshold(df, "y", "p", "min_bad_rate", min_approval=1.1).first()
    assert none["threshold"] is None and none["reason"]
    with pytest.raises(ValueError):
        find_optimal_threshold(df, "y", "p", "nope")


def test_segment_analysis_skips_small_and_null(spark):
    pdf = _pdf(2)
    res = {r["segment"]: r for r in segment_analysis(spark.createDataFrame(pdf), "y", "p", "seg").collect()}
    assert set(res) == {"a", "b"}
    assert res["a"]["sample_size"] == (pdf.seg == "a").sum()


def test_expected_loss_family(spark):
    pdf = _pdf(3)
    df = assign_decision(assign_risk_band(spark.createDataFrame(pdf), "p"), "p")
    el = pdf.p * pdf.ead * 0.45
    assert portfolio_expected_loss(df, "p", "ead", 0.45).first()[0] == pytest.approx(el.sum())
    bands = {r["risk_band"]: r for r in expected_loss_by_band(df, "p", "ead", 0.45).collect()}
    assert sum(r["total_el"] for r in bands.values()) == pytest.approx(el.sum())
    dec = {r["decision"]: r for r in el_by_decision(df, "p", "ead", 0.45).collect()}
    for r in dec.values():
        assert r["el_saved_vs_approve_all"] == pytest.approx(el.sum() - r["total_el"])
    a = el_with_assumptions(df, "p", 10000, 0.45).first()
    assert a["mean_expected_loss_per_account"] == pytest.approx((pdf.p * 4500).mean())


def test_sensitivity_grid_brute_force(spark):
    pdf = _pdf(4)
    rows = sensitivity_analysis(spark.createDataFrame(pdf), "p").collect()
    assert len(rows) == 25
    for r in rows:
        el = pdf.p * r["ead"] * r["lgd"]
        assert r["mean_el"] == pytest.approx(el.mean())
        assert r["median_el"] == pytest.approx(np.median(el))
        assert r["total_el"] == pytest.approx(el.sum())


def test_el_by_band_total_row(spark):
    from riskframe.operators.loss import expected_loss_by_group
    pdf = _pdf(5)
    df = assign_risk_band(spark.createDataFrame(pdf), "p")
    rows = expected_loss_by_group(df, "p", "ead", 0.45, "risk_band", with_total=True).collect()
    total = [r for r in rows if r["risk_band"] is None][0]
    assert total["total_el"] == pytest.approx(float((pdf.p * pdf.ead * 0.45).sum()))
    assert total["n_accounts"] == len(pdf)


def test_nan_scores_follow_numpy_comparisons(spark):
    from riskframe.operators.metrics import threshold_table
    df = spark.createDataFrame([(float("nan"), 1), (0.5, 1), (0.05, 0)], "p double, y int")
    assert [r["risk_band"] for r in assign_risk_band(df, "p").collect()] == ["Medium", "High", "Low"]
    r = threshold_table(df, "y", "p", [0.3]).first()
    assert (r["tp"], r["fn"], r["tn"], r["fp"]) == (1, 1, 1, 0)  # NaN row approved, not declined
