"""Models: quality contract on the loans fixture, weights, persistence, CV and selection."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators.curves import ranking_metrics
from riskframe.operators.metrics import evaluate_all
from riskframe.operators.models import CalibratedModel, ModelSpec, balanced_weight, class_counts, fit_model, pick_best
from riskframe.sources.tables import LOAN_KEY, loans

SF = "/root/testdata/sf0.01"
FEATS = ["l_quantity", "l_discount", "l_tax"]


@pytest.fixture(scope="module")
def parts(spark):
    l = loans(spark, SF)
    return l.where(F.col("split") == "train"), l.where(F.col("split") != "train")


def test_balanced_weights_average_one(spark, parts):
    tr, _ = parts
    n0, n1 = class_counts(tr, "y")
    w = tr.select(balanced_weight("y", n0, n1).alias("w")).agg(F.avg("w")).first()[0]
    assert w == pytest.approx(1.0)


def test_calibrated_logreg_contract(spark, parts, tmp_path):
    tr, te = parts
    m = fit_model(tr, FEATS, "y", ModelSpec("logreg"), calibrate=True, keys=LOAN_KEY)
    scored = m.score(te)
    r = evaluate_all(scored, "y", "pd").first()
    true_auc = ranking_metrics(te, "y", "p").first()["auc"]
    assert abs(r["auc"] - true_auc) < 0.01
    assert r["ece"] < 0.02
    m.save(str(tmp_path / "m"))
    m2 = CalibratedModel.load(spark, str(tmp_path / "m"))
    a = {tuple(x[:4]): x[4] for x in scored.select(*LOAN_KEY, "pd").collect()}
    b = {tuple(x[:4]): x[4] for x in m2.score(te).select(*LOAN_KEY, "pd").collect()}
    assert a == b


def test_forest_importance_and_pick_best(spark, parts):
    tr, te = parts
    rf = fit_model(tr, FEATS, "y", ModelSpec("rf", n_trees=10, max_depth=4), calibrate=True, keys=LOAN_KEY)
    imp = [r["feature"] for r in rf.feature_importance(spark).collect()]
    assert imp[0] == "l_quantity"
    lr = fit_model(tr, FEATS, "y", ModelSpec("logreg"), calibrate=True, keys=LOAN_KEY)
    scored = rf.score(lr.score(te, out="logreg"), out="rf")
    from riskframe.operators.metrics import compare_models
    best = pick_best(compare_models(scored, "y", ["logreg", "rf"]), "model", ["logreg", "rf"]).first()
    assert best["model"] in ("logreg", "rf")


def test_class_guard(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0)], "a double, y int")
    with pytest.raises(ValueError, match="both classes"):
        fit_model(df, ["a"], "y")


def test_evaluate_cv_out_of_fold(spark, parts):
    from riskframe.operators.models import evaluate_cv
    tr, _ = parts
    r = evaluate_cv(tr, FEATS, "y", ModelSpec("logreg"), folds=3, keys=LOAN_KEY).first()
    assert r["n"] == tr.count()  # every row scored exactly once, out of fold
    assert abs(r["auc_mean"] - r["auc"]) < 0.02 and r["auc_std"] >= 0
    assert r["brier_mean"] == r["brier"] and r["brier_std"] == 0.0
