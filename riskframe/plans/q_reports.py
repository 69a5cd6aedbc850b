"""Registered queries: attribution and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators.attribution import (
    dependence_data, global_importance, hash_sample, linear_attribution, local_examples, pick_diverse_examples,
    pick_spread_examples, rank_comparison, sampled_shapley,
)
from riskframe.operators.curves import ranking_metrics
from riskframe.operators.decisions import decision_metrics
from riskframe.operators.drift import calculate_psi
from riskframe.operators.loss import el_with_assumptions
from riskframe.operators.metrics import evaluate_all
from riskframe.operators.reports import metrics_report, retrain_trigger
from riskframe.plans.common import out
from riskframe.plans.registry import register
from riskframe.plans.scoring import top_drivers
from riskframe.plans.sql import (
    calib_ctes, point_ctes, psi_ctes, r6, ranking_ctes, risk_band_sql, sdiv, with_loans,
)
from riskframe.sources.tables import LOAN_KEY, loans, split_filter

KEYS_SQL = ", ".join(LOAN_KEY)
N_EXAMPLES = 6
SHAPLEY_BACKGROUND, SHAPLEY_PERMUTATIONS = 50, 8


def _top_drivers_sql() -> str:
    from riskframe.plans.q_woe import CAT, NUM, _recursive, transform_select, woe_ctes
    from riskframe.plans.sql import GAPS_CTE
    feats = NUM + CAT
    unp = " UNION ALL ".join(f"SELECT {KEYS_SQL}, rid, '{c}' AS feature, {c} AS woe FROM enc" for c in feats)
    return _recursive(with_loans(
        GAPS_CTE, *woe_ctes(), f"enc AS (SELECT {', '.join('t.' + k for k in LOAN_KEY)}, {transform_select('t')}, ROW_NUMBER() OVER () AS rid FROM gaps t)",
        f"u AS ({unp})",
        body=f"""SELECT {KEYS_SQL}, CAST(ROW_NUMBER() OVER (PARTITION BY rid ORDER BY ABS(woe) DESC, feature DESC, woe DESC) AS INTEGER) AS rank,
  feature, {r6('woe', 'woe')} FROM u"""))


@register("top_drivers", _top_drivers_sql())
def q_top_drivers(spark, sf):
    from riskframe.plans.q_woe import CAT, NUM, fitted
    from riskframe.sources.tables import loans_with_gaps
    te = loans_with_gaps(spark, sf).select(*LOAN_KEY, *NUM, *CAT)
    enc = fitted(spark, sf).transform(te)
    return out(top_drivers(enc, NUM + CAT, LOAN_KEY, 10).withColumn("rank", F.col("rank").cast("int")))


def _linear(spark, sf):
    from riskframe.plans.q_models import MODEL_FEATURES, _encoded, model_for
    m = model_for(spark, sf, "logreg", False)
    coefs = list(m.bases[0].coefficients.toArray())
    te = _encoded(spark, sf)
    tr = _encoded(spark, sf, "train")
    return linear_attribution(te, MODEL_FEATURES, coefs, LOAN_KEY, background=tr), dict(zip(MODEL_FEATURES, coefs))


@register("linear_attribution")
def q_linear_attribution(spark, sf):
    return out(_linear(spark, sf)[0])


@register("sampled_shapley")
def q_sampled_shapley(spark, sf):
    from riskframe.plans.q_models import MODEL_FEATURES, _encoded, model_for
    m = model_for(spark, sf, "logreg", True)
    rows = _encoded(spark, sf)
    bg = hash_sample(_encoded(spark, sf, "train"), LOAN_KEY, SHAPLEY_BACKGROUND, seed=7)
    res = sampled_shapley(rows, bg, MODEL_FEATURES, LOAN_KEY, lambda z: m.score(z, out="pd"),
                          n_permutations=SHAPLEY_PERMUTATIONS)
    return out(res)


@register("global_importance")
def q_global_importance(spark, sf):
    return out(global_importance(_linear(spark, sf)[0]))


def _diverse_sql() -> str:
    order_keys = ", ".join(f"{k} ASC" for k in LOAN_KEY)
    return with_loans(
        "te AS (SELECT * FROM loans)",
        f"lo AS (SELECT {KEYS_SQL}, p, 'low' AS example FROM te ORDER BY p ASC, {order_keys} LIMIT {N_EXAMPLES // 3})",
        f"hi AS (SELECT {KEYS_SQL}, p, 'high' AS example FROM te ORDER BY p DESC, {order_keys} LIMIT {N_EXAMPLES // 3})",
        f"""mid AS (SELECT {KEYS_SQL}, p, 'median' AS example FROM te ORDER BY ABS(p - (SELECT MEDIAN(p) FROM te)) ASC, {order_keys}
               LIMIT {N_EXAMPLES - 2 * (N_EXAMPLES // 3)})""",
        body=f"SELECT {KEYS_SQL}, {r6('p', 'p')}, example FROM lo UNION ALL SELECT * FROM hi UNION ALL SELECT * FROM mid")


@register("diverse_examples", _diverse_sql())
def q_diverse_examples(spark, sf):
    te = loans(spark, sf).select(*LOAN_KEY, "p")
    return out(pick_diverse_examples(te, "p", LOAN_KEY, N_EXAMPLES))


# Whole-number attributions of fixed coefficients around a fixed centre: sums are exact in both engines, ties are many.
SPREAD_COEF = {"l_quantity": (2, 25), "disc": (-3, 5), "tax": (5, 4)}
SPREAD_SQL = {"l_quantity": "CAST(l_quantity AS DOUBLE)", "disc": "CAST(ROUND(l_discount * 100) AS DOUBLE)",
              "tax": "CAST(ROUND(l_tax * 100) AS DOUBLE)"}
N_SPREAD = 7


def _spread_sql() -> str:
    total = " + ".join(f"ABS({c} * ({SPREAD_SQL[f]} - {m}))" for f, (c, m) in SPREAD_COEF.items())
    return with_loans(
        f"s AS (SELECT {KEYS_SQL}, SUM({total}) / (COUNT(*) * {len(SPREAD_COEF)}) AS m FROM loans GROUP BY {KEYS_SQL})",
        f"r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY m, {KEYS_SQL}) - 1 AS rn, COUNT(*) OVER () AS n FROM s)",
        f"w AS (SELECT i, LEAST(i * (n // {N_SPREAD}) + (n // {N_SPREAD}) // 2, n - 1) AS rk FROM "
        f"(SELECT UNNEST(RANGE({N_SPREAD})) AS i) x, (SELECT MAX(n) AS n FROM r) y)",
        body=f"""SELECT {KEYS_SQL}, {r6('m', 'mean_abs_attribution')}, CAST(i AS INTEGER) AS example, CAST(rk AS BIGINT) AS example_rank
FROM w JOIN r ON r.rn = w.rk""")


@register("diverse_examples_spread", _spread_sql())
def q_diverse_examples_spread(spark, sf):
    """X3 without scores: examples at evenly spaced ranks of mean |attribution| of every loan."""
    rows = loans(spark, sf).select(*LOAN_KEY, *[F.expr(e).alias(f) for f, e in SPREAD_SQL.items()])
    centre = spark.createDataFrame([tuple(float(m) for _, m in SPREAD_COEF.values())], ", ".join(f"{f} double" for f in SPREAD_COEF))
    attr = linear_attribution(rows, list(SPREAD_COEF), [c for c, _ in SPREAD_COEF.values()], LOAN_KEY, background=centre)
    return out(pick_spread_examples(attr, LOAN_KEY, N_SPREAD))


@register("local_examples")
def q_local_examples(spark, sf):
    attr, _ = _linear(spark, sf)
    te = loans(spark, sf).select(*LOAN_KEY, "p")
    ex = pick_diverse_examples(te, "p", LOAN_KEY, N_EXAMPLES)
    return out(local_examples(attr, ex, LOAN_KEY, "p"))


@register("rank_comparison")
def q_rank_comparison(spark, sf):
    attr, coefs = _linear(spark, sf)
    return out(rank_comparison(global_importance(attr), coefs, top_k=10))


@register("dependence_data")
def q_dependence_data(spark, sf):
    return out(dependence_data(_linear(spark, sf)[0]))


EVAL_METRICS = ["brier", "f1", "n", "n_pos", "auc", "ks", "pr_auc", "gini", "ece", "mce", "calibration_slope",
                "calibration_intercept", "n_bins_used"]
DEC_METRICS = ["approval_rate", "review_rate", "decline_rate", "bad_rate_approved", "default_capture_rate",
               "false_decline_rate", "n_approve", "n_review", "n_decline", "n_total"]
EL_METRICS = ["mean_expected_loss_per_account", "ead", "lgd"]
REPORT_EAD, REPORT_LGD = 10000.0, 0.45


def _report_sql() -> str:
    ev = with_loans(
        ranking_ctes("loans", by=["split"]), point_ctes("rk_sc", by=["split"]), calib_ctes("rk_sc", by=["split"]),
        "ev AS (SELECT pt.split, * EXCLUDE (split) FROM pt JOIN rk USING (split) JOIN cal USING (split))",
        f"dm AS (SELECT {risk_band_sql('p')} AS band, y FROM loans WHERE split = 'test')",
        """dma AS (SELECT COUNT(*) AS n_total, SUM(CASE WHEN band = 'Low' THEN 1 ELSE 0 END) AS n_approve,
             SUM(CASE WHEN band = 'Medium' THEN 1 ELSE 0 END) AS n_review, SUM(CASE WHEN band = 'High' THEN 1 ELSE 0 END) AS n_decline,
             SUM(CASE WHEN band = 'Low' AND y = 1 THEN 1 ELSE 0 END) AS bad_appr, SUM(CASE WHEN band = 'High' AND y = 1 THEN 1 ELSE 0 END) AS bad_decl,
             SUM(CASE WHEN band = 'High' AND y = 0 THEN 1 ELSE 0 END) AS good_decl, SUM(y) AS bad, SUM(1 - y) AS good FROM dm)""",
        f"""dmr AS (SELECT {sdiv('n_approve', 'n_total')} AS approval_rate, {sdiv('n_review', 'n_total')} AS review_rate,
             {sdiv('n_decline', 'n_total')} AS decline_rate, {sdiv('bad_appr', 'n_approve')} AS bad_rate_approved,
             {sdiv('bad_decl', 'bad')} AS default_capture_rate, {sdiv('good_decl', 'good')} AS false_decline_rate,
             n_approve, n_review, n_decline, n_total FROM dma)""",
        f"elr AS (SELECT AVG(p * {REPORT_EAD} * {REPORT_LGD}) AS mean_expected_loss_per_account, {REPORT_EAD} AS ead, {REPORT_LGD} AS lgd FROM loans WHERE split = 'test')",
        psi_ctes("SELECT 'k' AS key, p AS x FROM loans WHERE split = 'train'", "SELECT 'k' AS key, p AS x FROM loans WHERE split = 'test'"),
        body="SELECT 1",
    )
    ctes = ev.rsplit("\nSELECT 1", 1)[0]
    parts = []
    for sec in ("test", "oot"):
        for m in EVAL_METRICS:
            parts.append(f"SELECT '{sec}' AS section, 'p' AS model, '{m}' AS metric, ROUND(CAST({m} AS DOUBLE), 6) AS value FROM ev WHERE split = '{sec}'")
    parts += [f"SELECT 'decision', 'p', '{m}', ROUND(CAST({m} AS DOUBLE), 6) FROM dmr" for m in DEC_METRICS]
    parts += [f"SELECT 'expected_loss', 'p', '{m}', ROUND(CAST({m} AS DOUBLE), 6) FROM elr" for m in EL_METRICS]
    parts.append("SELECT 'psi', 'p', 'psi', ROUND(CAST(SUM(contrib) AS DOUBLE), 6) FROM psi_det")
    return ctes + "\n" + "\nUNION ALL ".join(parts)


@register("metrics_report", _report_sql())
def q_metrics_report(spark, sf):
    l = loans(spark, sf)
    te, oot, tr = (l.where(split_filter(s)) for s in ("test", "oot", "train"))
    sections = {
        "test": evaluate_all(te, "y", "p"),
        "oot": evaluate_all(oot, "y", "p"),
        "decision": decision_metrics(te, "y", "p"),
        "expected_loss": el_with_assumptions(te, "p", REPORT_EAD, REPORT_LGD).drop("total_expected_loss"),
        "psi": calculate_psi(tr, te, "p").select("psi"),
    }
    return out(metrics_report(sections, model="p"))


def _retrain_sql() -> str:
    return with_loans(
        ranking_ctes("loans", by=["split"]),
        psi_ctes("SELECT 'k' AS key, p AS x FROM loans WHERE split = 'train'", "SELECT 'k' AS key, p AS x FROM loans WHERE split = 'oot'"),
        "v AS (SELECT (SELECT auc FROM rk WHERE split = 'test') AS a0, (SELECT auc FROM rk WHERE split = 'oot') AS a1, (SELECT SUM(contrib) FROM psi_det) AS psi)",
        body=f"""SELECT {r6('a0', 'auc_reference')}, {r6('a1', 'auc_current')}, {r6('a0 - a1', 'auc_drop')}, {r6('psi', 'psi')},
  psi > 0.25 AS psi_trigger, (a0 - a1) > 0.05 AS auc_trigger, (psi > 0.25 OR (a0 - a1) > 0.05) AS retrain FROM v""")


@register("retrain_trigger", _retrain_sql())
def q_retrain_trigger(spark, sf):
    l = loans(spark, sf)
    te, oot, tr = (l.where(split_filter(s)) for s in ("test", "oot", "train"))
    return out(retrain_trigger(ranking_metrics(te, "y", "p"), ranking_metrics(oot, "y", "p"), calculate_psi(tr, oot, "p")))


@register("training_run")
def q_training_run(spark, sf):
    """The whole run on the loans view (features from lineitem, target y, hash split)."""
    from riskframe.config import RiskConfig
    from riskframe.plans.q_woe import CAT, NUM
    from riskframe.plans.training_run import run_training
    from riskframe.sources.tables import loans_with_gaps
    df = loans_with_gaps(spark, sf).select(*LOAN_KEY, *NUM, *CAT, "y")
    cfg = RiskConfig(target="y", iv_max=0.5)
    res = run_training(spark, df, cfg, LOAN_KEY)
    return out(res.report)


# Fixed scorecard of the registered scoring query: WOE is ln(good/bad), so risk falls as WOE rises.
SCORECARD_INTERCEPT = -0.4
SCORECARD_COEF = -1.0


def _scorecard_sql() -> str:
    from riskframe.plans.q_woe import CAT, NUM, _recursive, transform_select, woe_ctes
    from riskframe.plans.sql import GAPS_CTE
    z = f"{SCORECARD_INTERCEPT} + " + " + ".join(f"({SCORECARD_COEF}) * {c}" for c in NUM + CAT)
    pd_sql = f"1.0 / (1.0 + EXP(-({z})))"
    dec = "CASE WHEN pd IS NULL OR isnan(pd) THEN 'Manual Review' WHEN pd >= 0.3 THEN 'Decline' WHEN pd < 0.1 THEN 'Approve' ELSE 'Manual Review' END"
    return _recursive(with_loans(
        GAPS_CTE, *woe_ctes(), f"enc AS (SELECT {', '.join('t.' + k for k in LOAN_KEY)}, {transform_select('t')} FROM gaps t)",
        f"sc AS (SELECT {KEYS_SQL}, {pd_sql} AS pd FROM enc)",
        body=f"SELECT {KEYS_SQL}, {r6('pd', 'pd')}, {risk_band_sql('pd')} AS risk_band, {dec} AS decision FROM sc"))


@register("scorecard_decisions", _scorecard_sql())
def q_scorecard_decisions(spark, sf):
    """M9 with a fixed scorecard: WOE encode -> linear logit -> band -> decision, for every row."""
    from riskframe.operators.decisions import assign_decision, assign_risk_band
    from riskframe.plans.q_woe import CAT, NUM, fitted
    from riskframe.plans.scoring import scorecard
    from riskframe.sources.tables import loans_with_gaps
    te = loans_with_gaps(spark, sf).select(*LOAN_KEY, *NUM, *CAT)
    enc = fitted(spark, sf).transform(te)
    sc = scorecard(enc, {c: SCORECARD_COEF for c in NUM + CAT}, SCORECARD_INTERCEPT)
    res = assign_decision(assign_risk_band(sc, "pd"), "pd")
    return out(res.select(*LOAN_KEY, "pd", "risk_band", "decision"))
