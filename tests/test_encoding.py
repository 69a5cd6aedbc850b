"""WOE encoder: facts of the reference tests plus brute-force checks of the binning rules."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators.woe import MISSING_TOKEN, WoeEncoder, WoeModel


def _two_category(spark):
    rows = [("A", 0)] * 90 + [("A", 1)] * 10 + [("B", 0)] * 10 + [("B", 1)] * 10
    return spark.createDataFrame(rows, "feature string, target int")


def test_woe_sign_and_exact_values(spark):
    m = WoeEncoder().fit(_two_category(spark), ["feature"], "target")
    woe = {r["category"]: r["woe"] for r in m.get_woe_map("feature").collect()}
    # G = 100, B = 20: WOE(A) = ln((90/100)/(10/20)) = ln 1.8, WOE(B) = ln((10/100)/(10/20)) = ln 0.2
    assert woe["A"] == pytest.approx(math.log(1.8), abs=1e-5)
    assert woe["B"] == pytest.approx(math.log(0.2), abs=1e-5)
    assert woe["A"] > 0 > woe["B"]


def test_unseen_category_is_zero_and_error_mode(spark):
    m = WoeEncoder().fit(_two_category(spark), ["feature"], "target")
    new = spark.createDataFrame([("A",), ("C",), (None,)], "feature string")
    out = [r["feature"] for r in m.transform(new).collect()]
    assert out[1] == 0.0 and out[2] == 0.0
    m.handle_unknown = "error"
    with pytest.raises(Exception, match="Unseen value"):
        m.transform(new).collect()


def test_missing_category_gets_own_woe(spark):
    rows = [("A", 0)] * 40 + [("A", 1)] * 10 + [(None, 0)] * 5 + [(None, 1)] * 15
    df = spark.createDataFrame(rows, "feature string, target int")
    m = WoeEncoder().fit(df, ["feature"], "target")
    cats = {r["category"] for r in m.get_woe_map("feature").collect()}
    assert cats == {"A", MISSING_TOKEN}
    enc = m.transform(spark.createDataFrame([(None,)], "feature string")).first()[0]
    assert enc < 0  # the missing group is riskier


def test_numeric_binning_gives_doubles_without_missing(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=1000)
    y = (x + rng.normal(scale=0.5, size=1000) > 0.5).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"numeric_feat": x, "target": y}))
    m = WoeEncoder(n_bins=5).fit(df, ["numeric_feat"], "target")
    out = m.transform(df)
    assert dict(out.dtypes)["numeric_feat"] == "double"
    assert out.where(F.col("numeric_feat").isNull()).count() == 0
    assert 2 <= len(m.numeric_edges["numeric_feat"]) - 1 <= 5


def test_mixed_features_fitted(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"f1": rng.choice(["a", "b", "c"], 100), "f2": rng.normal(size=100),
                        "target": rng.integers(0, 2, 100)})
    m = WoeEncoder().fit(spark.createDataFrame(pdf), ["f1", "f2"], "target")
    assert set(m.features) == {"f1", "f2"}


def test_roundtrip_save_load(spark, tmp_path):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"feature": rng.choice(["x", "y", "z"], 100), "num": rng.normal(size=100),
                        "target": rng.integers(0, 2, 100)})
    df = spark.createDataFrame(pdf)
    m = WoeEncoder().fit(df, ["feature", "num"], "target")
    m.save(str(tmp_path / "enc"))
    m2 = WoeModel.load(spark, str(tmp_path / "enc"))
    assert m2.numeric_edges == m.numeric_edges
    a = sorted(m.transform(df).collect())
    b = sorted(m2.transform(df).collect())
    assert a == b


def _pandas_reference_bins(x: pd.Series, y: pd.Series, n_bins: int, min_bin_size: float):
    """Brute-force statement of the binning rule: qcut edges, shrink q while a bin is small."""
    def edges_for(q):
        return np.unique(np.quantile(x.dropna().to_numpy(), np.linspace(0, 1, q + 1)))

    def counts(e):
        return pd.cut(x, bins=e, include_lowest=True).value_counts(sort=False).to_numpy()

    e = edges_for(n_bins)
    c = counts(e)
    while (c < len(x) * min_bin_size).any() and len(e) > 3:
        e = edges_for(len(e) - 2)
        c = counts(e)
    binned = pd.cut(x, bins=e, include_lowest=True)
    g = pd.DataFrame({"b": binned, "y": y}).groupby("b", observed=False)["y"]
    return e, (g.apply(lambda s: (s == 0).sum())).to_numpy(), (g.apply(lambda s: (s == 1).sum())).to_numpy()


@pytest.mark.parametrize("seed,min_bin", [(0, 0.05), (1, 0.12), (2, 0.2)])
def test_min_bin_size_search_matches_brute_force(spark, seed, min_bin):
    rng = np.random.default_rng(seed)
    # zero-inflated, tied values so that merging actually happens
    x = np.where(rng.random(600) < 0.35, 0.0, np.round(rng.exponential(3, 600), 1))
    x[rng.random(600) < 0.05] = np.nan
    y = (rng.random(600) < 0.2 + 0.05 * np.nan_to_num(x)).astype(int)
    pdf = pd.DataFrame({"x": x, "target": y})
    m = WoeEncoder(n_bins=10, min_bin_size=min_bin).fit(spark.createDataFrame(pdf), ["x"], "target")
    e, g, b = _pandas_reference_bins(pdf["x"], pdf["target"], 10, min_bin)
    assert np.allclose(m.numeric_edges["x"], e, atol=1e-9)
    rows = m.bins.where(F.col("feature") == "x").orderBy("bin_id").collect()
    assert [r["good"] for r in rows] == list(g)
    assert [r["bad"] for r in rows] == list(b)


def test_constant_column_maps_to_zero(spark):
    df = spark.createDataFrame([(5.0, i % 2) for i in range(50)], "c double, target int")
    m = WoeEncoder().fit(df, ["c"], "target")
    assert {r[0] for r in m.transform(df).select("c").collect()} == {0.0}


def test_class_guard(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0)], "c double, target int")
    with pytest.raises(ValueError, match="both classes"):
        WoeEncoder().fit(df, ["c"], "target")


def test_equal_width_method(spark):
    rng = np.random.default_rng(4)
    x = rng.uniform(0, 10, 2000)
    y = (rng.random(2000) < x / 10).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "target": y}))
    m = WoeEncoder(n_bins=5, min_bin_size=0.0, method="width").fit(df, ["x"], "target")
    e = m.numeric_edges["x"]
    lo, hi = x.min(), x.max()
    assert len(e) == 6
    assert e[0] == pytest.approx(lo - (hi - lo) * 0.001)  # lowest edge widened by 0.1 % of the range
    assert np.allclose(np.diff(e[1:]), (hi - lo) / 5)
    counts = [r["good"] + r["bad"] for r in m.bins.orderBy("bin_id").collect()]
    assert sum(counts) == 2000
