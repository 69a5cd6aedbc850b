"""IV, correlation and VIF selection: facts of the reference tests plus brute-force checks."""

import math

import numpy as np
import pandas as pd
import pytest

from riskframe.operators.selection import (
    calculate_iv, calculate_vif, correlation_matrix, prune_by_correlation, prune_by_vif, select_by_iv, select_features,
    vif_from_corr,
)


def test_iv_perfect_separation(spark):
    df = spark.createDataFrame([(i % 2, i % 2) for i in range(100)], "perfect int, target int")
    iv = calculate_iv(df, "target", ["perfect"]).first()["iv"]
    assert iv > 0.5


def test_iv_noise_is_small(spark):
    rng = np.random.default_rng(42)
    pdf = pd.DataFrame({"noise_binned": rng.integers(0, 10, 10000).astype(str), "target": rng.integers(0, 2, 10000)})
    iv = calculate_iv(spark.createDataFrame(pdf), "target", ["noise_binned"]).first()["iv"]
    assert iv < 0.02


def test_iv_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.integers(0, 4, 500), "b": rng.choice(["x", "y", None], 500), "target": rng.integers(0, 2, 500)})
    res = {r["feature"]: (r["iv"], r["n_bins"]) for r in calculate_iv(spark.createDataFrame(pdf), "target").collect()}
    G, B = (pdf.target == 0).sum(), (pdf.target == 1).sum()
    for c in ["a", "b"]:
        g = pdf.dropna(subset=[c]).groupby(c)["target"].agg(good=lambda s: (s == 0).sum(), bad=lambda s: (s == 1).sum())
        gp, bp = (g.good + 1e-10) / (G + 1e-10), (g.bad + 1e-10) / (B + 1e-10)
        assert res[c][0] == pytest.approx(float(((gp - bp) * np.log(gp / bp)).sum()), rel=1e-9)
        assert res[c][1] == len(g)


def test_select_by_iv_range(spark):
    t = spark.createDataFrame([("a", 0.01), ("b", 0.1), ("c", 0.3), ("d", 0.6)], "feature string, iv double")
    assert [r["feature"] for r in select_by_iv(t, 0.02, 0.5).collect()] == ["c", "b"]


def test_constant_feature_iv_zero(spark):
    df = spark.createDataFrame([(1, i % 2) for i in range(100)], "constant int, target int")
    assert calculate_iv(df, "target", ["constant"]).first()["iv"] == 0.0


def test_correlation_prune(spark):
    rng = np.random.default_rng(42)
    f1 = rng.normal(size=1000)
    pdf = pd.DataFrame({"f1": f1, "f2": f1 + rng.normal(scale=0.01, size=1000), "f3": rng.normal(size=1000)})
    kept = prune_by_correlation(spark.createDataFrame(pdf), ["f1", "f2", "f3"], 0.8)
    assert len(kept) == 2 and "f3" in kept and "f1" in kept


def test_correlation_matrix_matches_pandas(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame(rng.normal(size=(300, 4)), columns=list("abcd"))
    pdf["b"] += pdf["a"]
    m = correlation_matrix(spark.createDataFrame(pdf), list("abcd"))
    assert np.allclose(m, pdf.corr().to_numpy(), atol=1e-9)
    ms = correlation_matrix(spark.createDataFrame(pdf), list("abcd"), "spearman")
    assert np.allclose(ms, pdf.corr(method="spearman").to_numpy(), atol=1e-9)


def _ols_vif(pdf, cols):
    out = {}
    for c in cols:
        others = [o for o in cols if o != c]
        X = np.column_stack([np.ones(len(pdf))] + [pdf[o].to_numpy() for o in others])
        yv = pdf[c].to_numpy()
        beta, *_ = np.linalg.lstsq(X, yv, rcond=None)
        r2 = 1 - ((yv - X @ beta) ** 2).sum() / ((yv - yv.mean()) ** 2).sum()
        out[c] = math.inf if r2 >= 1 - 1e-10 else 1 / (1 - r2)
    return out


def test_vif_exact_collinearity(spark):
    rng = np.random.default_rng(42)
    f1, f2 = rng.normal(size=500), rng.normal(size=500)
    pdf = pd.DataFrame({"f1": f1, "f2": f2, "f3": f1 + f2})
    v = {r["feature"]: r["vif"] for r in calculate_vif(spark.createDataFrame(pdf), ["f1", "f2", "f3"]).collect()}
    assert v["f3"] > 100


def test_vif_matches_ols(spark):
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=400), rng.normal(size=400)
    pdf = pd.DataFrame({"a": a, "b": b, "c": a + 0.5 * b + rng.normal(scale=0.3, size=400), "d": rng.normal(size=400)})
    corr = pdf.corr().to_numpy()
    ours = dict(zip(pdf.columns, vif_from_corr(corr)))
    ref = _ols_vif(pdf, list(pdf.columns))
    for c in pdf.columns:
        assert ours[c] == pytest.approx(ref[c], rel=1e-7)


def test_vif_prune_leaves_low_vif(spark):
    rng = np.random.default_rng(42)
    f1, f2 = rng.normal(size=500), rng.normal(size=500)
    pdf = pd.DataFrame({"f1": f1, "f2": f2, "f3": f1 + f2, "f4": 2 * f1})
    df = spark.createDataFrame(pdf)
    kept = prune_by_vif(df, ["f1", "f2", "f3", "f4"], 10.0)
    assert len(kept) <= 2
    assert all(v < 10 for v in _ols_vif(pdf, kept).values())


def test_vif_prune_matches_brute_force_loop(spark):
    rng = np.random.default_rng(11)
    a, b = rng.normal(size=300), rng.normal(size=300)
    pdf = pd.DataFrame({"a": a, "b": b, "c": a + b + rng.normal(scale=0.05, size=300), "d": a - rng.normal(scale=0.2, size=300)})
    remaining = list(pdf.columns)
    for _ in range(10):
        v = _ols_vif(pdf, remaining)
        worst = max(remaining, key=lambda c: (v[c], -remaining.index(c)))
        if v[worst] <= 5.0:
            break
        remaining.remove(worst)
    assert prune_by_vif(spark.createDataFrame(pdf), list(pdf.columns), 5.0) == remaining


def test_select_features_chain(spark):
    rng = np.random.default_rng(2)
    n = 2000
    y = rng.integers(0, 2, n)
    s = y + rng.normal(scale=1.0, size=n)
    pdf = pd.DataFrame({"strong": np.round(s, 1), "dup": np.round(s, 1) * 2.0, "noise": rng.integers(0, 3, n), "target": y})
    chosen, iv = select_features(spark.createDataFrame(pdf), "target", ["strong", "dup", "noise"], iv_min=0.02, iv_max=10.0)
    assert "noise" not in chosen
    assert len([c for c in chosen if c in ("strong", "dup")]) == 1
