"""Registered queries: risk bands, decision metrics, thresholds, segments."""

from __future__ import annotations


from riskframe.functions.bins import linspace, sql_float
from riskframe.operators.decisions import (
    assign_risk_band, decision_metrics, find_optimal_threshold, segment_analysis,
)
from riskframe.operators.metrics import DEFAULT_GRID, threshold_table
from riskframe.plans.common import out
from riskframe.plans.registry import register
from riskframe.plans.sql import r6, ranking_ctes, risk_band_sql, sdiv, with_loans
from riskframe.sources.tables import LOAN_KEY, loans

KEYS_SQL = ", ".join(LOAN_KEY)

_DM_SQL = with_loans(
    f"""b AS (SELECT y, {risk_band_sql('p')} AS band FROM loans)""",
    """a AS (SELECT COUNT(*) AS n_total,
      SUM(CASE WHEN band = 'Low' THEN 1 ELSE 0 END) AS n_approve,
      SUM(CASE WHEN band = 'Medium' THEN 1 ELSE 0 END) AS n_review,
      SUM(CASE WHEN band = 'High' THEN 1 ELSE 0 END) AS n_decline,
      SUM(CASE WHEN band = 'Low' AND y = 1 THEN 1 ELSE 0 END) AS bad_appr,
      SUM(CASE WHEN band = 'High' AND y = 1 THEN 1 ELSE 0 END) AS bad_decl,
      SUM(CASE WHEN band = 'High' AND y = 0 THEN 1 ELSE 0 END) AS good_decl,
      SUM(y) AS bad, SUM(1 - y) AS good FROM b)""",
    body=f"""SELECT {r6(sdiv('n_approve', 'n_total'), 'approval_rate')}, {r6(sdiv('n_review', 'n_total'), 'review_rate')},
  {r6(sdiv('n_decline', 'n_total'), 'decline_rate')}, {r6(sdiv('bad_appr', 'n_approve'), 'bad_rate_approved')},
  {r6(sdiv('bad_decl', 'bad'), 'default_capture_rate')}, {r6(sdiv('good_decl', 'good'), 'false_decline_rate')},
  CAST(n_approve AS BIGINT) AS n_approve, CAST(n_review AS BIGINT) AS n_review,
  CAST(n_decline AS BIGINT) AS n_decline, CAST(n_total AS BIGINT) AS n_total FROM a""",
)


@register("decision_metrics", _DM_SQL)
def q_decision_metrics(spark, sf):
    return out(decision_metrics(loans(spark, sf), "y", "p"))


@register("risk_bands", with_loans(body=f"SELECT {KEYS_SQL}, p, {risk_band_sql('p')} AS risk_band FROM loans"))
def q_risk_bands(spark, sf):
    return out(assign_risk_band(loans(spark, sf), "p").select(*LOAN_KEY, "p", "risk_band"))


def _threshold_sql(thresholds) -> str:
    vals = ", ".join(f"({sql_float(t)})" for t in thresholds)
    return with_loans(
        f"thr AS (SELECT * FROM (VALUES {vals}) v(threshold))",
        "sc AS (SELECT p, SUM(y) AS pos, SUM(1 - y) AS neg FROM loans GROUP BY p)",
        "tot AS (SELECT SUM(pos) AS P, SUM(neg) AS N FROM sc)",
        """c AS (SELECT t.threshold, SUM(CASE WHEN sc.p >= t.threshold THEN pos ELSE 0 END) AS tp,
             SUM(CASE WHEN sc.p >= t.threshold THEN neg ELSE 0 END) AS fp FROM thr t JOIN sc ON TRUE GROUP BY t.threshold)""",
        "m AS (SELECT c.threshold, tp, fp, P - tp AS fn, N - fp AS tn FROM c JOIN tot ON TRUE)",
        body=f"""SELECT {r6('threshold', 'threshold')}, {r6(sdiv('fn + tn', 'tp + fp + fn + tn'), 'approval_rate')},
  {r6(sdiv('tp', 'tp + fp'), 'bad_rate')}, {r6(sdiv('tp', 'tp + fn'), 'default_capture_rate')},
  {r6(sdiv('fn', 'fn + tn'), 'false_decline_rate')}, {r6(sdiv('tp', 'tp + fp'), 'precision')},
  {r6(sdiv('tp', 'tp + fn'), 'recall')}, {r6(sdiv('fn', 'fn + tn'), 'bad_rate_approved')},
  {r6(sdiv('fp', 'fp + tn'), 'false_decline_rate_of_goods')},
  CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn FROM m""",
    )


@register("threshold_table", _threshold_sql(linspace(*DEFAULT_GRID)))
def q_threshold_table(spark, sf):
    return out(threshold_table(loans(spark, sf), "y", "p"))


# Registered parameters of the optimal-threshold query.
OPT_OBJECTIVE, OPT_MIN_APPROVAL, OPT_MAX_BAD = "balanced", 0.05, 1.0


def _optimal_sql() -> str:
    base = _threshold_sql(linspace(*DEFAULT_GRID))
    inner = base.split("\nSELECT ", 1)
    ctes, sel = inner[0], "SELECT " + inner[1]
    return (ctes + f",\ntt AS ({sel}),\n"
            f"ok AS (SELECT *, approval_rate - bad_rate AS obj FROM tt WHERE approval_rate >= {OPT_MIN_APPROVAL} "
            f"AND bad_rate <= {OPT_MAX_BAD}),\n"
            "best AS (SELECT * FROM ok ORDER BY obj DESC, threshold ASC LIMIT 1)\n"
            "SELECT best.threshold, best.approval_rate, best.bad_rate, best.default_capture_rate, best.false_decline_rate,\n"
            f"  '{OPT_OBJECTIVE}' AS objective, CASE WHEN best.threshold IS NULL THEN 'No threshold satisfies constraints' END AS reason\n"
            "FROM (SELECT 1 AS k) one LEFT JOIN best ON TRUE")


@register("optimal_threshold", _optimal_sql())
def q_optimal_threshold(spark, sf):
    return out(find_optimal_threshold(loans(spark, sf), "y", "p", OPT_OBJECTIVE, OPT_MIN_APPROVAL, OPT_MAX_BAD))


_SEG_SQL = with_loans(
    ranking_ctes("loans", by=["l_returnflag"]),
    f"b AS (SELECT l_returnflag, y, {risk_band_sql('p')} AS band FROM loans WHERE l_returnflag IS NOT NULL)",
    """a AS (SELECT l_returnflag, COUNT(*) AS n_total,
      SUM(CASE WHEN band = 'Low' THEN 1 ELSE 0 END) AS n_approve,
      SUM(CASE WHEN band = 'Medium' THEN 1 ELSE 0 END) AS n_review,
      SUM(CASE WHEN band = 'High' THEN 1 ELSE 0 END) AS n_decline,
      SUM(CASE WHEN band = 'Low' AND y = 1 THEN 1 ELSE 0 END) AS bad_appr,
      SUM(CASE WHEN band = 'High' AND y = 1 THEN 1 ELSE 0 END) AS bad_decl,
      SUM(CASE WHEN band = 'High' AND y = 0 THEN 1 ELSE 0 END) AS good_decl,
      SUM(y) AS bad, SUM(1 - y) AS good FROM b GROUP BY l_returnflag)""",
    body=f"""SELECT a.l_returnflag AS segment, {r6(sdiv('n_approve', 'n_total'), 'approval_rate')},
  {r6(sdiv('n_review', 'n_total'), 'review_rate')}, {r6(sdiv('n_decline', 'n_total'), 'decline_rate')},
  {r6(sdiv('bad_appr', 'n_approve'), 'bad_rate_approved')}, {r6(sdiv('bad_decl', 'bad'), 'default_capture_rate')},
  {r6(sdiv('good_decl', 'good'), 'false_decline_rate')},
  CAST(n_approve AS BIGINT) AS n_approve, CAST(n_review AS BIGINT) AS n_review,
  CAST(n_decline AS BIGINT) AS n_decline, CAST(n_total AS BIGINT) AS sample_size,
  {r6('COALESCE(rk.auc, 0.5)', 'auc')}
FROM a LEFT JOIN rk ON a.l_returnflag = rk.l_returnflag WHERE n_total >= 10""",
)


@register("segment_analysis", _SEG_SQL)
def q_segment_analysis(spark, sf):
    return out(segment_analysis(loans(spark, sf), "y", "p", "l_returnflag"))
