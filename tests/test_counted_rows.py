"""Fits on counted rows: equal rows are one row with a number, and equal vectors are scored once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import attribution, models
from riskframe.operators.models import CalibratedModel, ModelSpec, fit_model, score_all

FEATS = ["a", "b", "c"]
FOREST = ModelSpec("rf", n_trees=6, max_depth=4)


@pytest.fixture(scope="module")
def rows(spark):
    u = lambda s: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(1000)) / 1000.0
    df = spark.range(4000).select("id", *[F.floor(u(s) * 5).cast("double").alias(f) for s, f in enumerate(FEATS)], u(9).alias("u"))
    return df.select("id", *FEATS, (F.col("u") < 0.1 + 0.15 * F.col("a") + 0.03 * F.col("b")).cast("int").alias("y")).localCheckpoint()


def test_forest_does_not_depend_on_partitions(rows):
    one, two = (fit_model(rows.repartition(n), FEATS, "y", FOREST, keys=["id"]) for n in (1, 7))
    nodes = lambda m: [[t.toDebugString.split("\n", 1)[1] for t in b.trees] for b in m.bases]
    assert nodes(one) == nodes(two)
    assert all(len(trees) == 6 and len(set(trees)) > 1 for trees in nodes(one))


def test_counted_forest_is_as_good_as_the_one_by_rows(spark, rows, tmp_path, monkeypatch):
    counted = fit_model(rows, FEATS, "y", FOREST, keys=["id"])
    monkeypatch.setattr(models, "COUNTED", 0)
    plain = fit_model(rows, FEATS, "y", FOREST, keys=["id"])
    monkeypatch.undo()
    got = rows.select(*FEATS).distinct()
    got = np.array(plain.score(counted.score(got, "x"), "z").select("x", "z").collect())
    assert np.abs(got[:, 0] - got[:, 1]).mean() < 0.03
    imp = [dict(m.feature_importance(spark).collect()) for m in (counted, plain)]
    assert max(imp[0], key=imp[0].get) == "a" and abs(imp[0]["a"] - imp[1]["a"]) < 0.15 and sum(imp[0].values()) == pytest.approx(1)
    counted.save(str(tmp_path))
    again = CalibratedModel.load(spark, str(tmp_path))
    assert sorted(again.score(rows).select("id", "pd").collect()) == sorted(counted.score(rows).select("id", "pd").collect())


def test_draws_are_poisson():
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"__n": [40] * 3000, "__row": list(range(3000))})
    [out] = models._drawn(1, 2)(iter([batch]))
    draws = np.array(out.column("__draws").to_pylist())
    assert abs(draws.mean() - 40) < 0.5 and abs(draws.var() - 40) < 3
    assert abs(np.corrcoef(draws.T)[0, 1]) < 0.1


def test_each_vector_is_scored_once(rows, monkeypatch):
    m = fit_model(rows, FEATS, "y", ModelSpec("logreg"), keys=["id"])
    seen = []
    score = CalibratedModel.score
    monkeypatch.setattr(CalibratedModel, "score", lambda self, df, out="pd": (seen.append(df.count()), score(self, df, out))[1])
    got = score_all(rows, {"p": m, "q": m})
    assert max(seen) == rows.select(*FEATS).distinct().count()
    assert sorted(got.select("id", "p", "q").collect()) == sorted(score(m, score(m, rows, "p"), "q").select("id", "p", "q").collect())
    monkeypatch.setattr(models, "COUNTED", 3)
    assert sorted(score_all(rows, {"p": m}).select("id", "p").collect()) == sorted(got.select("id", "p").collect())


def test_shapley_scores_each_mixture_once(rows, monkeypatch):
    scored = []

    def scorer(z):
        scored.append(z.count())
        return z.withColumn("pd", F.col("a") * F.col("b") + F.col("c") * F.col("c") * F.col("a") - F.col("b"))

    some = rows.limit(300).union(rows.limit(20))  # repeated keys are explained one by one
    run = lambda: sorted(attribution.sampled_shapley(some, rows.limit(5), FEATS, ["id"], scorer, n_permutations=4).collect())
    got = run()
    assert scored == [some.select(*FEATS).distinct().count() * rows.limit(5).count() * 2 ** len(FEATS)]
    monkeypatch.setattr(attribution, "MIXTURES", 0)
    by_row = run()
    assert len(got) == 320 * 3 and [r[:2] for r in got] == [r[:2] for r in by_row]
    assert np.array([r[2:] for r in got]) == pytest.approx(np.array([r[2:] for r in by_row]), abs=1e-12)


def test_boosted_trees_read_counted_rows(spark, rows, tmp_path, monkeypatch):
    from pyspark.ml.base import Estimator
    seen = []
    fit = Estimator.fit
    monkeypatch.setattr(Estimator, "fit", lambda self, df, *a: (seen.append(df.count()), fit(self, df, *a))[1])
    spec = ModelSpec("gbt", n_trees=5, max_depth=3, subsample=0.8, colsample=0.8)
    counted = fit_model(rows, FEATS, "y", spec, calibrate=False, keys=["id"])
    assert max(seen) <= rows.select(*FEATS, "y").distinct().count() < 4000
    other = fit_model(rows.repartition(7), FEATS, "y", spec, calibrate=False, keys=["id"])
    assert counted.bases[0].toDebugString.split("\n", 1)[1] == other.bases[0].toDebugString.split("\n", 1)[1]
    assert dict(counted.feature_importance(spark).collect())["a"] > 0.5
    counted.save(str(tmp_path))
    again = CalibratedModel.load(spark, str(tmp_path))
    assert sorted(again.score(rows).select("id", "pd").collect()) == sorted(counted.score(rows).select("id", "pd").collect())


@pytest.mark.parametrize("share, most", [(1.0, 1e-9), (0.8, 0.05)])
def test_counted_boosted_trees_are_those_by_rows(rows, monkeypatch, share, most):
    """Where each tree sees all rows, the same trees up to sums; else other draws of the same share."""
    spec = ModelSpec("gbt", n_trees=6, max_depth=3, subsample=share, colsample=1.0)
    counted = fit_model(rows, FEATS, "y", spec, calibrate=False, keys=["id"])
    monkeypatch.setattr(models, "COUNTED", 0)
    plain = fit_model(rows, FEATS, "y", spec, calibrate=False, keys=["id"])
    got = np.array(plain.score(counted.score(rows.select(*FEATS).distinct(), "x"), "z").select("x", "z").collect())
    assert np.abs(got[:, 0] - got[:, 1]).max() < most and got[:, 0].std() > 0.1


def test_drawn_shares_are_binomial():
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"__n": [40] * 3000, "__row": list(range(3000))})
    [out] = models._drawn(1, 2, 0.75)(iter([batch]))
    draws = np.array(out.column("__draws").to_pylist())
    assert abs(draws.mean() - 30) < 0.3 and abs(draws.var() - 7.5) < 0.8 and draws.max() <= 40
