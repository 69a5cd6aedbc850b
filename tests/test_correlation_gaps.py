"""Pairwise correlations of a wide frame with missing values against pandas, and what the job reads."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators import selection
from riskframe.operators.selection import corr_from_moments, correlation_matrix, pair_moments


def _gappy(n, p, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 3))
    x = base @ rng.normal(size=(3, p)) + rng.normal(size=(n, p))
    x[:, 1] = np.round(x[:, 1])                    # ties
    x[:, 2] = x[:, 2] * 1e-9 + 1e6                 # small spread far from zero
    x[:, 3] = 7.5                                  # constant
    x[:, 4] *= 1e160                               # squares overflow
    x[rng.random((n, p)) < 0.1] = np.nan
    x[:, 5] = np.round(base[:, 0], 1)              # complete
    x[:, 6] = -x[:, 5]
    return pd.DataFrame(x, columns=[f"f{i}" for i in range(p)])


def test_pearson_121_columns_in_two_scans(spark, tmp_path, monkeypatch):
    pdf = _gappy(1000, 121)
    path = str(tmp_path / "wide")
    spark.createDataFrame(pdf.replace({np.nan: None})).repartition(6).write.parquet(path)
    df = spark.read.parquet(path)
    scans = []
    run = selection.pair_moments

    def counted(values, feats):
        out = run(values, feats)
        scans.append(out._jdf.queryExecution().optimizedPlan().toString().count("Relation"))
        return out
    monkeypatch.setattr(selection, "pair_moments", counted)
    got = correlation_matrix(df, list(pdf.columns))
    assert scans == [1]                            # and one aggregate for centre and scale
    pdf["f2"] -= 1e6                               # exact in doubles; pandas itself loses digits with the offset
    pdf["f4"] /= 1e160
    want = pdf.corr().to_numpy()
    want[3, :] = want[:, 3] = np.nan
    assert (np.isnan(got) == np.isnan(want)).all()
    assert np.nanmax(np.abs(got - want)) < 1e-9


def test_spearman_with_gaps_equals_pandas(spark):
    pdf = _gappy(800, 8, 1)
    pdf["f4"] /= 1e160
    pdf.loc[pdf.index[:50], "f1"] = -0.0
    pdf.loc[pdf.index[50:90], "f1"] = 0.0
    df = spark.createDataFrame(pdf.replace({np.nan: None})).repartition(5)
    got = correlation_matrix(df, list(pdf.columns), "spearman")
    want = pdf.corr("spearman").to_numpy()
    want[3, 3] = np.nan
    assert (np.isnan(got) == np.isnan(want)).all()
    assert np.nanmax(np.abs(got - want)) < 1e-9


def test_moments_of_parts_add_up_and_odd_tables(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 5.0), (None, 1.0), (4.0, 4.0)], "a double, b double")
    r = corr_from_moments(pair_moments(df.repartition(3), ["a", "b"])).collect()
    assert [(x["i"], x["j"]) for x in r] == [(0, 1)]
    assert r[0]["corr"] == pytest.approx(np.corrcoef([1, 3, 4], [2, 5, 4])[0, 1], abs=1e-12)
    assert np.isnan(correlation_matrix(df.limit(0), ["a", "b"])).all()
    assert np.isnan(correlation_matrix(df.limit(0), ["a", "b"], "spearman")[0, 1])
    assert correlation_matrix(df, ["a"]).tolist() == [[1.0]]
    nulls = df.withColumn("b", F.lit(None).cast("double"))
    for method in ("pearson", "spearman"):
        assert np.isnan(correlation_matrix(nulls, ["a", "b"], method)[0, 1])
