"""Registered queries: models, calibration, importance, CV, scoring."""

from __future__ import annotations


from pyspark.sql import functions as F

from riskframe.operators import isotonic
from riskframe.operators.metrics import compare_models
from riskframe.operators.models import (
    ModelSpec, class_weight_table, evaluate_cv, fit_model, pick_best, score_all,
)
from riskframe.plans.common import out
from riskframe.plans.registry import register
from riskframe.plans.scoring import score_batch
from riskframe.plans.sql import r6, with_loans, GAPS_CTE
from riskframe.sources.tables import LOAN_KEY, loans_with_gaps, split_filter

MODEL_FEATURES = ["l_quantity", "l_discount", "l_tax"]
# Registered model settings (forest as configured in the reference: 50 trees, depth 8).
SPECS = {
    "logreg": ModelSpec("logreg", C=1.0),
    "rf": ModelSpec("rf", n_trees=50, max_depth=8),
    "gbt": ModelSpec("gbt", n_trees=20, max_depth=4, learning_rate=0.1, subsample=0.8, colsample=0.8),
}
_CACHE: dict = {}


def _encoded(spark, sf, part: str | None = None):
    from riskframe.plans.q_woe import fitted
    enc = fitted(spark, sf)
    rows = loans_with_gaps(spark, sf)
    rows = rows if part is None else rows.where(split_filter(part))
    return enc.transform(rows.select(*LOAN_KEY, "y", "p", *MODEL_FEATURES))


def model_for(spark, sf, name: str, calibrate: bool = True):
    key = (spark.sparkContext.applicationId, sf, name, calibrate)
    if key not in _CACHE:
        _CACHE[key] = fit_model(_encoded(spark, sf, "train"), MODEL_FEATURES, "y", SPECS[name], calibrate=calibrate,
                                keys=LOAN_KEY)
    return _CACHE[key]


@register("class_weights", with_loans(GAPS_CTE, "tr AS (SELECT * FROM gaps WHERE split = 'train')", body=f"""SELECT y AS class,
  CAST(COUNT(*) AS BIGINT) AS n, {r6('(SELECT COUNT(*) FROM tr) / (2.0 * COUNT(*))', 'weight')} FROM tr GROUP BY y"""))
def q_class_weights(spark, sf):
    tr = loans_with_gaps(spark, sf).where(split_filter("train"))
    return out(class_weight_table(tr, "y"))


def _scores(spark, sf, name, calibrate):
    m = model_for(spark, sf, name, calibrate)
    return out(score_all(_encoded(spark, sf), {"pd": m}).select(*LOAN_KEY, "y", "pd"))


@register("logreg_scores")
def q_logreg_scores(spark, sf):
    return _scores(spark, sf, "logreg", False)


@register("rf_scores")
def q_rf_scores(spark, sf):
    return _scores(spark, sf, "rf", False)


@register("gbt_scores")
def q_gbt_scores(spark, sf):
    return _scores(spark, sf, "gbt", False)


@register("calibrated_scores")
def q_calibrated_scores(spark, sf):
    return _scores(spark, sf, "logreg", True)


@register("feature_importance")
def q_feature_importance(spark, sf):
    return out(model_for(spark, sf, "rf", True).feature_importance(spark))


@register("cv_metrics")
def q_cv_metrics(spark, sf):
    return out(evaluate_cv(_encoded(spark, sf, "train"), MODEL_FEATURES, "y", SPECS["logreg"], folds=3, keys=LOAN_KEY))


@register("score_batch")
def q_score_batch(spark, sf):
    from riskframe.plans.q_woe import fitted
    res = score_batch(loans_with_gaps(spark, sf), fitted(spark, sf), model_for(spark, sf, "logreg", True), keep=LOAN_KEY)
    return out(res.select(*LOAN_KEY, "pd", "risk_band", "decision"))


MODEL_ORDER = ["logreg", "rf"]


@register("pick_best")
def q_pick_best(spark, sf):
    te = _encoded(spark, sf, "test")
    scored = score_all(te, {name: model_for(spark, sf, name, True) for name in MODEL_ORDER})
    metrics = compare_models(scored, "y", MODEL_ORDER)
    return out(pick_best(metrics, "model", MODEL_ORDER).select("model", "auc", "ece", "selection_score"))


def _isotonic_sql() -> str:
    """The max-min formula over distinct scores: the largest, over starts, of the smallest mean up to any end."""
    return with_loans(
        "x AS (SELECT p AS score, COUNT(*) AS n, SUM(y) AS s FROM loans GROUP BY p)",
        "c AS (SELECT *, ROW_NUMBER() OVER o AS i, SUM(n) OVER o AS cn, SUM(s) OVER o AS cs FROM x WINDOW o AS (ORDER BY score))",
        "m AS (SELECT a.i AS a, b.i AS b, CAST(b.cs - a.cs + a.s AS DOUBLE) / (b.cn - a.cn + a.n) AS mean FROM c a JOIN c b ON b.i >= a.i)",
        """l AS (SELECT a, b, MIN(mean) OVER (PARTITION BY a ORDER BY b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS low FROM m)""",
        "f AS (SELECT b AS i, MAX(low) AS v FROM l GROUP BY b)",
        body=f"SELECT score, CAST(n AS BIGINT) AS n, {r6('v', 'calibrated')} FROM c JOIN f USING (i)")


@register("isotonic_calibration", _isotonic_sql())
def q_isotonic_calibration(spark, sf):
    rows = loans_with_gaps(spark, sf).select("p", "y")
    model = isotonic.fit(rows, "p", "y")
    scores = rows.groupBy(F.col("p").alias("score")).agg(F.count(F.lit(1)).alias("n"))
    return out(model.setFeaturesCol("score").transform(scores).select("score", "n", F.col("__cal").alias("calibrated")))
