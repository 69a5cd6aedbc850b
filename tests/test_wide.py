"""The reference's real table has 121 features: fit, transform, IV and selection must stay
single-pass and codegen-friendly at that width."""

import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskframe.operators.selection import select_features
from riskframe.operators.woe import WoeEncoder


def test_121_features(spark):
    rng = np.random.default_rng(0)
    n, p = 20000, 116
    X = rng.normal(size=(n, p)).round(3)
    logit = X[:, :5] @ np.array([0.8, -0.5, 0.3, 0.2, -0.1])
    y = (rng.random(n) < 1 / (1 + np.exp(-logit))).astype(int)
    pdf = pd.DataFrame(X, columns=[f"n{i}" for i in range(p)])
    for j in range(5):
        pdf[f"c{j}"] = rng.choice(["a", "b", "c", None], n)
    pdf["target"] = y
    # A distributed, persisted input like a real scan: a pandas-created LocalRelation would make the
    # optimizer evaluate every projection on the driver (ConvertToLocalRelation) and time that instead.
    df = spark.createDataFrame(pdf).repartition(8).persist()
    feats = [c for c in pdf.columns if c != "target"]
    t0 = time.time()
    m = WoeEncoder().fit(df, feats, "target")
    enc = m.transform(df)
    assert enc.where(F.col("n0").isNull()).count() == 0
    plan = enc._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    chosen, iv = select_features(enc, "target", feats, iv_min=0.02, iv_max=2.0)
    assert {"n0", "n1"} <= set(chosen)
    assert iv.count() == len(feats)
    assert time.time() - t0 < 300
