"""Registered queries: correlation, VIF and the selection chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators.selection import (
    calculate_vif, correlation_pairs, prune_by_correlation, prune_by_vif, select_features,
)
from riskframe.plans.common import out
from riskframe.plans.registry import register
from riskframe.plans.sql import GAPS_CTE, r6, with_loans
from riskframe.sources.tables import loans, loans_with_gaps

# Derived near-duplicate of quantity so that pruning has something to drop.
QTY_TAX_SQL = "CAST(l_quantity AS DOUBLE) * 2.0 + l_tax"
SEL = ["l_quantity", "l_extendedprice", "l_discount", "qty_tax"]
CORR_THRESHOLD = 0.8
VIF_THRESHOLD = 10.0


def _frame(spark, sf):
    return loans(spark, sf).withColumn("qty_tax", F.expr(QTY_TAX_SQL))


def _src_cte() -> str:
    return f"src AS (SELECT l_quantity, l_extendedprice, l_discount, {QTY_TAX_SQL} AS qty_tax FROM loans)"


def _pairs_cte() -> str:
    parts = [f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM src"
             for i, a in enumerate(SEL) for j, b in enumerate(SEL) if i < j]
    return "pairs AS (" + " UNION ALL ".join(parts) + ")"


@register("correlation_pairs", with_loans(_src_cte(), _pairs_cte(),
                                          body=f"SELECT a AS feature_a, b AS feature_b, {r6('r', 'corr')} FROM pairs"))
def q_correlation_pairs(spark, sf):
    return out(correlation_pairs(_frame(spark, sf), SEL))


# Missing values in two of four columns, ties in all: both methods over pairwise-complete rows.
GAPS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


def _corr_gaps_sql() -> str:
    parts = []
    for i, a in enumerate(GAPS):
        for b in GAPS[i + 1:]:
            both = f"(SELECT CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM gaps WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
            rank = lambda c: (f"RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0")
            parts.append(f"SELECT 'pearson' AS method, '{a}' AS feature_a, '{b}' AS feature_b, {r6('corr(x, y)', 'corr')} FROM {both}")
            parts.append(f"SELECT 'spearman', '{a}', '{b}', {r6('corr(x, y)', 'corr')} "
                         f"FROM (SELECT {rank('x')} AS x, {rank('y')} AS y FROM {both})")
    return with_loans(GAPS_CTE, body=" UNION ALL ".join(parts))


@register("correlation_gaps", _corr_gaps_sql())
def q_correlation_gaps(spark, sf):
    df = loans_with_gaps(spark, sf)
    both = [correlation_pairs(df, GAPS, m).withColumn("method", F.lit(m)) for m in ("pearson", "spearman")]
    return out(both[0].unionByName(both[1]).select("method", "feature_a", "feature_b", "corr"))


def _prune_sql() -> str:
    feats = ", ".join(f"({i + 1}, '{c}')" for i, c in enumerate(SEL))
    body = f"""SELECT CAST(ROW_NUMBER() OVER () AS INTEGER) AS position, feature FROM (SELECT UNNEST(kept) AS feature FROM g WHERE pos = {len(SEL)})"""
    sql = with_loans(_src_cte(), _pairs_cte(), f"feats AS (SELECT * FROM (VALUES {feats}) v(pos, f))",
                     f"""g AS (SELECT 1 AS pos, ['{SEL[0]}'] AS kept
      UNION ALL
      SELECT g.pos + 1, CASE WHEN EXISTS (SELECT 1 FROM pairs p JOIN feats ON feats.f = p.b WHERE feats.pos = g.pos + 1
          AND list_contains(g.kept, p.a) AND ABS(p.r) > {CORR_THRESHOLD})
        THEN g.kept ELSE list_append(g.kept, (SELECT f FROM feats WHERE feats.pos = g.pos + 1)) END FROM g WHERE g.pos < {len(SEL)})""",
                     body=body)
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@register("correlation_prune", _prune_sql())
def q_correlation_prune(spark, sf):
    kept = prune_by_correlation(_frame(spark, sf), SEL, CORR_THRESHOLD)
    return spark.createDataFrame([(i + 1, c) for i, c in enumerate(kept)], "position int, feature string")


VIF3 = ["l_quantity", "l_extendedprice", "l_discount"]


def _vif_sql() -> str:
    a, b, c = VIF3
    rows = []
    for j, (x, y) in zip(VIF3, [(b, c), (a, c), (a, b)]):
        rx, ry, rxy = f"corr({j}, {x})", f"corr({j}, {y})", f"corr({x}, {y})"
        r2 = f"(({rx})*({rx}) + ({ry})*({ry}) - 2*({rx})*({ry})*({rxy})) / (1 - ({rxy})*({rxy}))"
        rows.append(f"SELECT '{j}' AS feature, {r6(f'1.0 / (1.0 - {r2})', 'vif')} FROM loans")
    return with_loans(body=" UNION ALL ".join(rows))


@register("vif", _vif_sql())
def q_vif(spark, sf):
    return out(calculate_vif(loans(spark, sf), VIF3))


@register("vif_prune")
def q_vif_prune(spark, sf):
    kept = prune_by_vif(_frame(spark, sf), SEL, VIF_THRESHOLD)
    return spark.createDataFrame([(i + 1, c) for i, c in enumerate(kept)], "position int, feature string")


@register("select_features")
def q_select_features(spark, sf):
    from riskframe.plans.q_woe import CAT, NUM, _train, fitted
    enc = fitted(spark, sf).transform(_train(spark, sf).select(*NUM, *CAT, "y"))
    chosen, _ = select_features(enc, "y", NUM + CAT)
    return spark.createDataFrame([(i + 1, c) for i, c in enumerate(chosen)], "position int, feature string")
