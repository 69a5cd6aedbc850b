"""Registered queries: expected loss (L1-L6). EAD = l_extendedprice, LGD = 0.45."""

from __future__ import annotations

from riskframe.functions.bins import linspace, sql_float
from riskframe.operators.decisions import BAND_DECISIONS, assign_decision, assign_risk_band
from riskframe.operators.loss import (
    ASSUMPTION_NOTE, DEFAULT_EAD, SENS_EAD_RANGE, SENS_LGD_RANGE, SENS_POINTS, el_by_decision, el_with_assumptions,
    expected_loss_by_band, portfolio_expected_loss, sensitivity_analysis,
)
from riskframe.plans.common import out
from riskframe.plans.registry import register
from riskframe.plans.sql import r2, r6, risk_band_sql, with_loans
from riskframe.sources.tables import loans

LGD = 0.45
EAD = "l_extendedprice"
EL_SQL = f"p * l_extendedprice * {LGD}"
MONEY = ("total_el", "total_ead", "el_saved_vs_approve_all", "total_expected_loss")


@register("el_portfolio", with_loans(body=f"SELECT {r2(f'SUM({EL_SQL})', 'total_el')} FROM loans"))
def q_el_portfolio(spark, sf):
    return out(portfolio_expected_loss(loans(spark, sf), "p", EAD, LGD), money=MONEY)


@register("el_by_band", with_loans(body=f"""SELECT {risk_band_sql('p')} AS risk_band, CAST(COUNT(*) AS BIGINT) AS n_accounts,
  {r2('SUM(l_extendedprice)', 'total_ead')}, {r2(f'SUM({EL_SQL})', 'total_el')}, {r6('AVG(p)', 'avg_pd')},
  {r6(str(LGD), 'avg_lgd')}, {r6(f'SUM({EL_SQL}) / SUM(l_extendedprice)', 'el_pct_of_ead')}
FROM loans GROUP BY 1"""))
def q_el_by_band(spark, sf):
    return out(expected_loss_by_band(assign_risk_band(loans(spark, sf), "p"), "p", EAD, LGD), money=MONEY)


_DEC_SQL = "CASE " + " ".join(
    f"WHEN ({risk_band_sql('p')}) = '{b}' THEN '{d}'" for b, d in BAND_DECISIONS.items()) + " END"


@register("el_by_decision", with_loans(
    f"g AS (SELECT {_DEC_SQL} AS decision, COUNT(*) AS n, SUM(l_extendedprice) AS ead, SUM({EL_SQL}) AS el, AVG(p) AS apd FROM loans GROUP BY 1)",
    body=f"""SELECT decision, CAST(n AS BIGINT) AS n_accounts, {r2('ead', 'total_ead')}, {r2('el', 'total_el')},
  {r6('apd', 'avg_pd')}, {r2('(SELECT SUM(el) FROM g) - el', 'el_saved_vs_approve_all')} FROM g"""))
def q_el_by_decision(spark, sf):
    return out(el_by_decision(assign_decision(loans(spark, sf), "p"), "p", EAD, LGD), money=MONEY)


def _sens_sql() -> str:
    grid = ", ".join(f"({sql_float(e)}, {sql_float(g)})" for e in linspace(*SENS_EAD_RANGE, SENS_POINTS)
                     for g in linspace(*SENS_LGD_RANGE, SENS_POINTS))
    return with_loans(f"grid AS (SELECT * FROM (VALUES {grid}) v(ead, lgd))",
                      "st AS (SELECT AVG(p) AS m, SUM(p) AS s, MEDIAN(p) AS med FROM loans)",
                      body=f"""SELECT {r6('ead', 'ead')}, {r6('lgd', 'lgd')}, {r6('m * ead * lgd', 'mean_el')},
  {r2('s * ead * lgd', 'total_el')}, {r6('med * ead * lgd', 'median_el')} FROM grid JOIN st ON TRUE""")


@register("el_sensitivity", _sens_sql())
def q_el_sensitivity(spark, sf):
    return out(sensitivity_analysis(loans(spark, sf), "p"), money=MONEY)


@register("el_assumptions", with_loans(body=f"""SELECT {r2(f'SUM(p * {DEFAULT_EAD} * {LGD})', 'total_expected_loss')},
  {r6(f'AVG(p * {DEFAULT_EAD} * {LGD})', 'mean_expected_loss_per_account')}, {r6(str(DEFAULT_EAD), 'ead')}, {r6(str(LGD), 'lgd')},
  '{ASSUMPTION_NOTE}' AS note FROM loans"""))
def q_el_assumptions(spark, sf):
    return out(el_with_assumptions(loans(spark, sf), "p", DEFAULT_EAD, LGD), money=MONEY)


@register("el_by_band_total", with_loans(body=f"""SELECT {risk_band_sql('p')} AS risk_band, CAST(COUNT(*) AS BIGINT) AS n_accounts,
  {r2('SUM(l_extendedprice)', 'total_ead')}, {r2(f'SUM({EL_SQL})', 'total_el')}, {r6('AVG(p)', 'avg_pd')},
  {r6(str(LGD), 'avg_lgd')}, {r6(f'SUM({EL_SQL}) / SUM(l_extendedprice)', 'el_pct_of_ead')}
FROM loans GROUP BY ROLLUP(1)"""))
def q_el_by_band_total(spark, sf):
    """L3 with the portfolio total as an extra row (band = NULL) from the same aggregate (rollup)."""
    from riskframe.operators.loss import expected_loss_by_group
    df = assign_risk_band(loans(spark, sf), "p")
    return out(expected_loss_by_group(df, "p", EAD, LGD, "risk_band", with_total=True), money=MONEY)
