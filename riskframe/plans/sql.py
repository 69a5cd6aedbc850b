"""Shared SQL text for the DuckDB oracles (same arithmetic as the Spark builders)."""

from __future__ import annotations

from riskframe.functions.bins import sql_float
from riskframe.sources.tables import LOAN_HASH_SQL, LOAN_SCORE_SQL, SPLIT_TEST_END, SPLIT_TRAIN_END

LOANS_CTE = f"""loans AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_extendedprice,
         l_linestatus, l_returnflag, l_shipdate, s_int,
         CAST(s_int AS DOUBLE) / 10000.0 AS p,
         CASE WHEN {LOAN_HASH_SQL} < s_int THEN 1 ELSE 0 END AS y,
         CASE WHEN l_shipdate < TIMESTAMP '{SPLIT_TRAIN_END}' THEN 'train'
              WHEN l_shipdate < TIMESTAMP '{SPLIT_TEST_END}' THEN 'test' ELSE 'oot' END AS split
  FROM (SELECT *, {LOAN_SCORE_SQL} AS s_int FROM lineitem) t
)"""


def with_loans(*ctes: str, body: str) -> str:
    parts = [LOANS_CTE, *ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


def r6(expr: str, alias: str) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), 6) AS {alias}"


def sdiv(num: str, den: str) -> str:
    """num/den as double, 0 when den is 0 or null."""
    return f"COALESCE(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0), 0.0)"


def left_index_sql(col: str, cuts) -> str:
    cuts = list(cuts)
    if not cuts:
        return f"CASE WHEN {col} IS NULL THEN NULL ELSE 0 END"
    whens = " ".join(f"WHEN {col} < {sql_float(c)} THEN {i}" for i, c in enumerate(cuts))
    return f"CASE WHEN {col} IS NULL THEN NULL {whens} ELSE {len(cuts)} END"


def risk_band_sql(col: str, low: float = 0.10, high: float = 0.30) -> str:
    return f"CASE WHEN {col} >= {sql_float(high)} THEN 'High' WHEN {col} < {sql_float(low)} THEN 'Low' ELSE 'Medium' END"


def ranking_ctes(src: str, target: str = "y", score: str = "p", by: list[str] | None = None, prefix: str = "rk") -> str:
    """CTEs ``{prefix}_sc``, ``{prefix}_cu`` and ``{prefix}`` (by..., auc, ks, pr_auc, gini)."""
    by = by or []
    g = ", ".join(by)
    gsel = (g + ", ") if by else ""
    part = f"PARTITION BY {g} " if by else ""
    grp = f"GROUP BY {g}" if by else ""
    return f"""{prefix}_sc AS (
  SELECT {gsel}{score} AS s, CAST(SUM(CASE WHEN {target} = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
         CAST(SUM(CASE WHEN {target} = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS neg
  FROM {src} WHERE {score} IS NOT NULL AND {target} IS NOT NULL GROUP BY {gsel}{score}
),
{prefix}_cu AS (
  SELECT {gsel}s, pos, neg,
    COALESCE(SUM(neg) OVER ({part}ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb,
    COALESCE(SUM(pos) OVER ({part}ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pb,
    SUM(pos) OVER ({part[:-1] if by else ''}) AS tp_, SUM(neg) OVER ({part[:-1] if by else ''}) AS tn_
  FROM {prefix}_sc
),
{prefix} AS (
  SELECT {gsel}SUM(pos * (nb + neg / 2.0)) / NULLIF(MAX(tp_) * MAX(tn_), 0) AS auc,
    GREATEST(0.0, COALESCE(MAX(nb / NULLIF(tn_, 0) - pb / NULLIF(tp_, 0)), 0.0)) AS ks,
    SUM((tp_ - pb) / NULLIF((tp_ - pb) + (tn_ - nb), 0) * pos) / NULLIF(MAX(tp_), 0) AS pr_auc,
    2.0 * (SUM(pos * (nb + neg / 2.0)) / NULLIF(MAX(tp_) * MAX(tn_), 0)) - 1.0 AS gini
  FROM {prefix}_cu {grp}
)"""


GAPS_CTE = """gaps AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, NULLIF(l_discount, 0.0) AS l_discount,
         NULLIF(l_tax, 0.0) AS l_tax, l_extendedprice, l_linestatus, NULLIF(l_returnflag, 'R') AS l_returnflag,
         l_shipdate, p, y, split
  FROM loans
)"""


def calib_ctes(sc: str, by: list[str] | None = None, n_bins: int = 10, prefix: str = "cal") -> str:
    """From a collapsed CTE ``sc(by..., s, pos, neg)``: ``{prefix}_bins`` and ``{prefix}``
    (by..., ece, mce, calibration_slope, calibration_intercept, n_bins_used)."""
    from riskframe.functions.bins import linspace
    by = by or []
    g = ", ".join(by)
    gsel = (g + ", ") if by else ""
    grp = f"GROUP BY {g}" if by else ""
    idx = left_index_sql("s", linspace(0.0, 1.0, n_bins + 1)[1:-1])
    lx = "LN((mean_pred + 1e-6) / (1 - mean_pred + 1e-6))"
    ly = "LN((event_rate + 1e-6) / (1 - event_rate + 1e-6))"
    return f"""{prefix}_bins AS (
  SELECT {gsel}bin, SUM(s * (pos + neg)) / SUM(pos + neg) AS mean_pred, SUM(pos) / SUM(pos + neg) AS event_rate,
         CAST(SUM(pos + neg) AS BIGINT) AS n
  FROM (SELECT *, {idx} AS bin FROM {sc}) b GROUP BY {gsel}bin HAVING SUM(pos + neg) > 0
),
{prefix} AS (
  SELECT {gsel}SUM(ABS(mean_pred - event_rate) * n) / SUM(n) AS ece, MAX(ABS(mean_pred - event_rate)) AS mce,
    CASE WHEN COUNT(*) > 1 THEN REGR_SLOPE({ly}, {lx}) ELSE 1.0 END AS calibration_slope,
    CASE WHEN COUNT(*) > 1 THEN REGR_INTERCEPT({ly}, {lx}) ELSE 0.0 END AS calibration_intercept,
    CAST(COUNT(*) AS BIGINT) AS n_bins_used
  FROM {prefix}_bins {grp}
)"""


def point_ctes(sc: str, by: list[str] | None = None, threshold: float = 0.5, prefix: str = "pt") -> str:
    by = by or []
    g = ", ".join(by)
    gsel = (g + ", ") if by else ""
    grp = f"GROUP BY {g}" if by else ""
    t = sql_float(threshold)
    tp = f"SUM(CASE WHEN s >= {t} THEN pos ELSE 0 END)"
    fp = f"SUM(CASE WHEN s >= {t} THEN neg ELSE 0 END)"
    fn = f"SUM(CASE WHEN s < {t} THEN pos ELSE 0 END)"
    return f"""{prefix} AS (
  SELECT {gsel}SUM(pos * (s - 1.0) * (s - 1.0) + neg * s * s) / SUM(pos + neg) AS brier,
    {sdiv(f'2.0 * {tp}', f'2.0 * {tp} + {fp} + {fn}')} AS f1,
    CAST(SUM(pos + neg) AS BIGINT) AS n, CAST(SUM(pos) AS BIGINT) AS n_pos
  FROM {sc} {grp}
)"""


def r2(expr: str, alias: str) -> str:
    """Money columns: large sums rounded to cents (see ``plans.common.out``)."""
    return f"ROUND(ROUND(CAST({expr} AS DOUBLE), 6), 2) AS {alias}"


def psi_ctes(e_src: str, a_src: str, buckets: int = 10) -> str:
    """From ``e(key, x)`` / ``a(key, x)`` sources: CTE ``psi_det`` with
    (key, bucket, lo, hi, ec, ac, ep, ap, contrib, ne, na)."""
    import numpy as np
    fr = "[" + ", ".join(repr(float(v)) for v in np.linspace(0.0, 1.0, buckets + 1)) + "]"
    return f"""pe AS ({e_src}),
pa AS ({a_src}),
pqa AS (SELECT key, quantile_cont(x, {fr}) AS es FROM pe WHERE x IS NOT NULL GROUP BY key),
pfr AS (SELECT key, UNNEST(es) AS v, UNNEST({fr}) AS frac FROM pqa),
ped AS (SELECT DISTINCT key, v FROM pfr),
pedo AS (SELECT key, v, ROW_NUMBER() OVER (PARTITION BY key ORDER BY v) - 1 AS i, COUNT(*) OVER (PARTITION BY key) AS k FROM ped),
pbk AS (SELECT a.key, a.i AS bucket, a.v AS lo, b.v AS hi FROM pedo a JOIN pedo b ON a.key = b.key AND b.i = a.i + 1),
ptag AS (SELECT key, x, 1 AS is_e FROM pe WHERE x IS NOT NULL UNION ALL SELECT key, x, 0 FROM pa WHERE x IS NOT NULL),
pas AS (SELECT t.key, t.is_e, (SELECT COUNT(*) FROM pedo WHERE pedo.key = t.key AND pedo.i >= 1 AND pedo.i <= pedo.k - 2
          AND pedo.v <= t.x) AS bucket FROM ptag t WHERE t.key IN (SELECT key FROM pedo WHERE k >= 2)),
pcnt AS (SELECT key, bucket, SUM(is_e) AS ec, SUM(1 - is_e) AS ac FROM pas GROUP BY key, bucket),
pdet AS (SELECT pbk.key, pbk.bucket, pbk.lo, pbk.hi, CAST(COALESCE(ec, 0) AS DOUBLE) AS ec, CAST(COALESCE(ac, 0) AS DOUBLE) AS ac
         FROM pbk LEFT JOIN pcnt ON pbk.key = pcnt.key AND pbk.bucket = pcnt.bucket),
ppc AS (SELECT *, SUM(ec) OVER (PARTITION BY key) AS ne, SUM(ac) OVER (PARTITION BY key) AS na FROM pdet),
psi_det AS (SELECT key, bucket, lo, hi, ec, ac, ne, na, GREATEST(ec / ne, 1e-10) AS ep, GREATEST(ac / na, 1e-10) AS ap,
            (GREATEST(ac / na, 1e-10) - GREATEST(ec / ne, 1e-10)) * LN(GREATEST(ac / na, 1e-10) / GREATEST(ec / ne, 1e-10)) AS contrib
            FROM ppc)"""


def psi_label_sql(col: str) -> str:
    return f"CASE WHEN {col} < 0.1 THEN 'stable' WHEN {col} < 0.25 THEN 'moderate_shift' ELSE 'significant_drift' END"
