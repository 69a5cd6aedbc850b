"""Order statistics by bracket and count against numpy, in one round and in several."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators import order_stats

FRACTIONS = [0.0, 0.013, 0.1, 1 / 3, 0.5, 0.77, 0.999, 1.0]


def frame(n=6000):
    rng = np.random.default_rng(4)
    hot = rng.normal(size=n)
    hot[: n // 3] = 0.25
    return pd.DataFrame({
        "normal": rng.normal(size=n), "hot": rng.permutation(hot), "coarse": rng.integers(-3, 4, n).astype(float),
        "tiny": 1 + rng.integers(0, 2000, n) * 1e-11, "constant": 7.0, "missing": np.nan,
        "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.exponential(size=n) * 1e6), "signs": rng.choice([-1e300, -0.0, 0.0, 5e-324, 1e300], n)})


@pytest.mark.parametrize("grid,accuracy,gather", [(400, 4000, 20_000), (400, 4000, 50), (7, 20, 40), (3, 5, 1)])
def test_against_numpy(spark, monkeypatch, grid, accuracy, gather):
    for name, v in (("GRID", grid), ("ACCURACY", accuracy), ("GATHER", gather)):
        monkeypatch.setattr(order_stats, name, v)
    pdf = frame(1500 if gather < 40 else 6000)
    df = spark.createDataFrame(pdf).repartition(5)
    got = order_stats.quantiles(df, {c: F.col(c) for c in pdf}, FRACTIONS)
    assert got["missing"] is None
    for c in pdf:
        if c != "missing":
            with np.errstate(over="ignore"):
                assert got[c] == pytest.approx(np.nanquantile(pdf[c], FRACTIONS).tolist(), rel=1e-15, abs=0), c


def test_empty_and_nulls(spark):
    none = spark.createDataFrame([], "x double")
    assert order_stats.quantiles(none, {"x": F.col("x")}, [0.5]) == {"x": None}
    one = spark.createDataFrame([(None,), (3,), (None,)], "x int")
    assert order_stats.quantiles(one, {"x": F.col("x")}, [0.0, 0.5, 1.0]) == {"x": [3.0, 3.0, 3.0]}


def test_no_value_is_a_shuffle_key(spark, monkeypatch):
    """Every exchange of a round is keyed by feature and cell, or gathers one row of aggregates."""
    monkeypatch.setattr(order_stats, "GATHER", 50)
    seen = []
    plain = order_stats.cells

    def watched(df, splits, keep=()):
        out = plain(df, splits, keep)
        seen.append(out.groupBy("feature", "cell").count()._jdf.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(order_stats, "cells", watched)
    pdf = frame()[["normal", "hot"]]
    order_stats.quantiles(spark.createDataFrame(pdf), {c: F.col(c) for c in pdf}, FRACTIONS)
    assert len(seen) >= 2
    for plan in seen:
        keys = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert keys and all("feature#" in k and "cell#" in k and " v#" not in k for k in keys)
