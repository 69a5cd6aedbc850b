"""Registered queries: discrimination and calibration metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators.calibration import calibration_metrics, reliability_curve
from riskframe.operators.curves import collapse_scores, ranking_metrics
from riskframe.operators.metrics import compare_models, evaluate_all, point_metrics
from riskframe.plans.common import out
from riskframe.plans.registry import register
from riskframe.plans.sql import calib_ctes, point_ctes, r6, ranking_ctes, with_loans
from riskframe.sources.tables import loans

# Second score of the model comparison: quantity alone, scaled to (0, 1].
ALT_SCORE_SQL = "CAST(l_quantity AS DOUBLE) / 50.0"


@register("auc_gini_ks", with_loans(ranking_ctes("loans", by=["split"]),
                                    body=f"SELECT split, {r6('auc', 'auc')}, {r6('gini', 'gini')}, {r6('ks', 'ks')} FROM rk"))
def q_auc_gini_ks(spark, sf):
    return out(ranking_metrics(loans(spark, sf), "y", "p", by=["split"]).select("split", "auc", "gini", "ks"))


@register("average_precision", with_loans(ranking_ctes("loans"), body=f"SELECT {r6('pr_auc', 'pr_auc')} FROM rk"))
def q_average_precision(spark, sf):
    return out(ranking_metrics(loans(spark, sf), "y", "p").select("pr_auc"))


@register("brier_f1", with_loans(ranking_ctes("loans", by=["split"]), point_ctes("rk_sc", by=["split"]),
                                 body=f"SELECT split, {r6('brier', 'brier')}, {r6('f1', 'f1')}, n, n_pos FROM pt"))
def q_brier_f1(spark, sf):
    c = collapse_scores(loans(spark, sf), "y", "p", ["split"])
    return out(point_metrics(c, "p", ["split"]))


@register("reliability_curve", with_loans(ranking_ctes("loans"), calib_ctes("rk_sc"),
                                          body=f"SELECT CAST(bin AS INTEGER) AS bin, {r6('mean_pred', 'mean_pred')}, "
                                               f"{r6('event_rate', 'event_rate')}, n FROM cal_bins"))
def q_reliability_curve(spark, sf):
    return out(reliability_curve(loans(spark, sf), "y", "p"))


@register("ece_mce", with_loans(ranking_ctes("loans", by=["split"]), calib_ctes("rk_sc", by=["split"]),
                                body=f"SELECT split, {r6('ece', 'ece')}, {r6('mce', 'mce')} FROM cal"))
def q_ece_mce(spark, sf):
    return out(calibration_metrics(loans(spark, sf), "y", "p", by=["split"]).select("split", "ece", "mce"))


@register("calibration_slope", with_loans(ranking_ctes("loans"), calib_ctes("rk_sc"),
                                          body=f"SELECT {r6('calibration_slope', 'calibration_slope')}, "
                                               f"{r6('calibration_intercept', 'calibration_intercept')}, n_bins_used FROM cal"))
def q_calibration_slope(spark, sf):
    return out(calibration_metrics(loans(spark, sf), "y", "p")
               .select("calibration_slope", "calibration_intercept", "n_bins_used"))


EVAL_COLS = ["auc", "pr_auc", "gini", "ks", "brier", "f1", "ece", "mce", "calibration_slope", "calibration_intercept"]


def _eval_sql(src: str, by: list[str]) -> str:
    g = ", ".join(f"pt.{b}" for b in by)
    join = " AND ".join(f"pt.{b} = {{t}}.{b}" for b in by)
    cols = ", ".join(r6(c, c) for c in EVAL_COLS)
    return with_loans(
        f"src AS ({src})", ranking_ctes("src", score="s0", by=by), point_ctes("rk_sc", by=by), calib_ctes("rk_sc", by=by),
        body=f"""SELECT {g}, {cols}, pt.n, pt.n_pos, cal.n_bins_used FROM pt JOIN rk ON {join.format(t='rk')}
JOIN cal ON {join.format(t='cal')}""")


@register("evaluate_all", _eval_sql("SELECT split, y, p AS s0 FROM loans", ["split"]))
def q_evaluate_all(spark, sf):
    return out(evaluate_all(loans(spark, sf), "y", "p", by=["split"]))


@register("compare_models", _eval_sql(
    f"SELECT 'p' AS model, y, p AS s0 FROM loans UNION ALL SELECT 'p_qty', y, {ALT_SCORE_SQL} FROM loans", ["model"]))
def q_compare_models(spark, sf):
    l = loans(spark, sf).withColumn("p_qty", F.expr(ALT_SCORE_SQL))
    return out(compare_models(l, "y", ["p", "p_qty"]))
