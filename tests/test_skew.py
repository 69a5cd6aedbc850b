"""Hot keys: exact results when one value holds a third of the rows, and the join path of the encoder."""

import numpy as np
import pandas as pd
import pytest

import riskframe.operators.woe as woe_mod
from riskframe.operators.binning import exact_quantiles
from riskframe.operators.curves import ranking_metrics
from riskframe.operators.woe import WoeEncoder


def test_ranking_with_hot_score(spark):
    rng = np.random.default_rng(0)
    n = 6000
    s = np.round(rng.random(n), 3)
    s[: n // 3] = 0.5  # one score value holds a third of all rows
    y = (rng.random(n) < s).astype(int)
    pdf = pd.DataFrame({"y": y, "s": s})
    r = ranking_metrics(spark.createDataFrame(pdf), "y", "s", n_buckets=16).first()
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert r["auc"] == pytest.approx(auc, abs=1e-12)


def test_exact_quantiles_with_hot_value(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=3001)
    x[:1000] = 0.25
    x[5:9] = np.nan
    df = spark.createDataFrame(pd.DataFrame({"x": x, "z": np.round(x * 3)}))
    fr = [0.0, 0.1, 1 / 3, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["x", "z"], fr)
    assert np.allclose(got["x"], np.nanquantile(x, fr), atol=1e-12)
    assert np.allclose(got["z"], np.nanquantile(np.round(x * 3), fr), atol=1e-12)


def test_categorical_join_path_with_hot_category(spark, monkeypatch):
    rng = np.random.default_rng(2)
    n = 3000
    cat = rng.choice([f"c{i}" for i in range(50)], n).astype(object)
    cat[: n // 3] = "hot"
    y = rng.integers(0, 2, n)
    pdf = pd.DataFrame({"k": np.arange(n), "cat": cat, "target": y})
    df = spark.createDataFrame(pdf)
    m_map = WoeEncoder().fit(df, ["cat"], "target")
    expected = {r["k"]: r["cat"] for r in m_map.transform(df).collect()}
    monkeypatch.setattr(woe_mod, "MAP_LOOKUP_MAX", 1)  # force the join path
    m_join = WoeEncoder().fit(df, ["cat"], "target")
    new = df.union(spark.createDataFrame([(n, "unseen", 0)], "k long, cat string, target long"))
    got = {r["k"]: r["cat"] for r in m_join.transform(new).collect()}
    assert got[n] == 0.0
    for k, v in expected.items():
        assert got[k] == pytest.approx(v, abs=1e-12)
