"""Isotonic blocks from merged ranges against the max-min formula."""

import numpy as np
import pandas as pd
import pytest

from riskframe.operators import isotonic


def max_min(x, y, w):
    """Isotonic fit at each distinct score: largest, over starts, of the smallest mean up to any end."""
    xs = np.unique(x)
    ws, ss = (np.array([(v * (x == a)).sum() for a in xs]) for v in (w, w * y))
    cw, cs = np.r_[0, ws.cumsum()], np.r_[0, ss.cumsum()]
    k = len(xs)
    mean = np.full((k, k), np.inf)
    for a in range(k):
        mean[a, a:] = (cs[a + 1:] - cs[a]) / (cw[a + 1:] - cw[a])
    low = np.minimum.accumulate(mean[:, ::-1], axis=1)[:, ::-1]
    return xs, np.array([low[: i + 1, i].max() for i in range(k)])


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_blocks_match_max_min(spark, ranges):
    rng = np.random.default_rng(ranges)
    x = np.round(rng.normal(size=900), 2)
    x[:300] = 0.5  # a hot score
    y = (rng.random(900) < 1 / (1 + np.exp(-x))).astype(float)
    w = rng.integers(1, 4, 900).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y, "w": w}))
    blocks = isotonic.fit_blocks(df, "x", "y", "w", ranges)
    xs, want = max_min(x, y, w)
    got = np.array([next(v for lo, hi, _, v in blocks if lo <= a <= hi) for a in xs])
    assert np.allclose(got, want, atol=1e-12)
    assert all(a[3] < b[3] and a[1] < b[0] for a, b in zip(blocks, blocks[1:]))
    model = isotonic.fit(df, "x", "y", "w", ranges=ranges)
    rows = model.transform(spark.createDataFrame([(float(a),) for a in xs], "x double")).toPandas()
    assert np.allclose(rows["__cal"], want, atol=1e-12)


def test_missing_rows_do_not_count_and_empty_fails(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 1.0), (None, 1.0), (float("nan"), 1.0), (3.0, None)], "x double, y double")
    assert isotonic.fit_blocks(df, "x", "y") == [(1.0, 1.0, 1.0, 0.0), (2.0, 2.0, 1.0, 1.0)]
    with pytest.raises(ValueError):
        isotonic.fit(df.limit(0), "x", "y")
