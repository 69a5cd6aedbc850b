"""Ranking and calibration metrics against brute-force statements, plus plan properties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators.calibration import calibration_metrics, reliability_curve
from riskframe.operators.curves import ranking_metrics
from riskframe.operators.metrics import evaluate_all, threshold_table


def _fixture(seed=0, n=3000, ties=True):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    s = 1 / (1 + np.exp(-(y * 1.2 + rng.normal(size=n))))
    if ties:
        s = np.round(s, 2)
    return pd.DataFrame({"y": y, "s": s})


def _brute(pdf):
    y, s = pdf.y.to_numpy(), pdf.s.to_numpy()
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    thr = np.unique(s)[::-1]
    tpr = np.array([(pos >= t).mean() for t in thr])
    fpr = np.array([(neg >= t).mean() for t in thr])
    ks = max(0.0, (tpr - fpr).max())
    prec = np.array([(pos >= t).sum() / (s >= t).sum() for t in thr])
    rec = np.concatenate([[0.0], tpr])
    ap = float(np.sum(np.diff(rec) * prec))
    return auc, ks, ap


@pytest.mark.parametrize("ties,buckets", [(True, 8), (False, 8), (False, 1), (True, 64)])
def test_ranking_metrics_match_brute_force(spark, ties, buckets):
    pdf = _fixture(1, 2500, ties)
    r = ranking_metrics(spark.createDataFrame(pdf), "y", "s", n_buckets=buckets).first()
    auc, ks, ap = _brute(pdf)
    assert r["auc"] == pytest.approx(auc, abs=1e-12)
    assert r["ks"] == pytest.approx(ks, abs=1e-12)
    assert r["pr_auc"] == pytest.approx(ap, abs=1e-12)
    assert r["gini"] == pytest.approx(2 * auc - 1, abs=1e-12)


def test_auc_of_negated_score(spark):
    pdf = _fixture(2)
    df = spark.createDataFrame(pdf)
    a = ranking_metrics(df, "y", "s").first()["auc"]
    b = ranking_metrics(df.withColumn("s", -F.col("s")), "y", "s").first()["auc"]
    assert a + b == pytest.approx(1.0, abs=1e-12)


def test_grouped_ranking_equals_per_group(spark):
    pdf = _fixture(3)
    pdf["g"] = np.where(np.arange(len(pdf)) % 3 == 0, "a", "b")
    df = spark.createDataFrame(pdf)
    grouped = {r["g"]: r["auc"] for r in ranking_metrics(df, "y", "s", by=["g"]).collect()}
    for g in ("a", "b"):
        assert grouped[g] == pytest.approx(_brute(pdf[pdf.g == g])[0], abs=1e-12)


def test_reliability_bins_left_closed(spark):
    pdf = pd.DataFrame({"y": [0, 1, 1, 0, 1], "s": [0.1, 0.1, 0.95, 1.0, 0.0999]})
    bins = {r["bin"]: r for r in reliability_curve(spark.createDataFrame(pdf), "y", "s").collect()}
    assert bins[1]["n"] == 2        # 0.1 is the left edge of bin 1
    assert bins[0]["n"] == 1
    assert bins[9]["n"] == 2        # 1.0 is clipped into the last bin


def test_calibration_invariants(spark):
    pdf = _fixture(4, ties=False)
    r = calibration_metrics(spark.createDataFrame(pdf), "y", "s").first()
    assert 0 <= r["ece"] <= r["mce"]
    # brute force ECE
    b = np.clip(np.digitize(pdf.s, np.linspace(0, 1, 11)) - 1, 0, 9)
    g = pd.DataFrame({"b": b, "s": pdf.s, "y": pdf.y}).groupby("b").agg(m=("s", "mean"), r=("y", "mean"), n=("s", "size"))
    assert r["ece"] == pytest.approx(float((abs(g.m - g.r) * g.n).sum() / g.n.sum()), abs=1e-12)
    lx, ly = np.log((g.m + 1e-6) / (1 - g.m + 1e-6)), np.log((g.r + 1e-6) / (1 - g.r + 1e-6))
    slope, intercept = np.polyfit(lx, ly, 1)
    assert r["calibration_slope"] == pytest.approx(slope, rel=1e-9)
    assert r["calibration_intercept"] == pytest.approx(intercept, rel=1e-9, abs=1e-12)


def test_evaluate_all_brier_f1(spark):
    pdf = _fixture(5)
    r = evaluate_all(spark.createDataFrame(pdf), "y", "s").first()
    assert r["brier"] == pytest.approx(float(((pdf.s - pdf.y) ** 2).mean()), abs=1e-12)
    pred = (pdf.s >= 0.5).astype(int)
    tp = ((pred == 1) & (pdf.y == 1)).sum()
    fp = ((pred == 1) & (pdf.y == 0)).sum()
    fn = ((pred == 0) & (pdf.y == 1)).sum()
    assert r["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn), abs=1e-12)


def test_threshold_table_matches_brute_force(spark):
    pdf = _fixture(6)
    ts = [0.2, 0.35, 0.35, 0.5, 0.8]
    rows = threshold_table(spark.createDataFrame(pdf), "y", "s", ts).orderBy("threshold").collect()
    assert len(rows) == len(ts)
    for r in rows:
        t = r["threshold"]
        dec = pdf.s >= t
        tp = (dec & (pdf.y == 1)).sum()
        fp = (dec & (pdf.y == 0)).sum()
        fn = (~dec & (pdf.y == 1)).sum()
        tn = (~dec & (pdf.y == 0)).sum()
        assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (tp, fp, fn, tn)
        assert r["approval_rate"] == pytest.approx((fn + tn) / len(pdf))
        assert r["false_decline_rate"] == pytest.approx(fn / (fn + tn))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_partition_or_python_in_ranking_plan(spark):
    from riskframe.sources.tables import loans
    df = ranking_metrics(loans(spark, "/root/testdata/sf0.001"), "y", "p", n_buckets=8)
    plan = df._jdf.queryExecution().optimizedPlan().toString() + _plan(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # The only single-partition exchange allowed sits on the per-bucket totals (<= n_buckets rows):
    # the operator right below it must be the aggregate keyed by the score bucket.
    lines = _plan(df).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1]
            assert "HashAggregate" in below and "_b" in below, below
    # rows are windowed per (group, score bucket)
    assert any("Window" in l and "_b" in l for l in lines)
