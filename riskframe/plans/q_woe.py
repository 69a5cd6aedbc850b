"""Registered queries: quantile edges, WOE bins, WOE transform, IV (E*, F1-F3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators.binning import dedupe_edges, numeric_bin_stats, quantile_edges, quantile_fractions
from riskframe.operators.selection import calculate_iv, select_by_iv
from riskframe.operators.woe import MISSING_TOKEN, WoeEncoder
from riskframe.plans.common import out
from riskframe.plans.registry import register
from riskframe.plans.sql import GAPS_CTE, r6, with_loans
from riskframe.sources.tables import LOAN_KEY, loans_with_gaps, split_filter

NUM = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
CAT = ["l_linestatus", "l_returnflag"]
N_BINS, MIN_BIN = 10, 0.05
KEYS_SQL = ", ".join(LOAN_KEY)


def _train(spark, sf):
    return loans_with_gaps(spark, sf).where(split_filter("train"))


_MODEL_CACHE: dict = {}


def fitted(spark, sf):
    """The encoder of the registered WOE queries, fitted once per (session, sf) on the train split."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODEL_CACHE:
        _MODEL_CACHE[key] = WoeEncoder(N_BINS, MIN_BIN).fit(_train(spark, sf).select(*NUM, *CAT, "y"), NUM + CAT, "y")
    return _MODEL_CACHE[key]


def _flist(vals) -> str:
    return "[" + ", ".join(repr(float(v)) for v in vals) + "]"


def woe_ctes(src: str = "gaps WHERE split = 'train'") -> list[str]:
    """CTEs ending in ``nbins(feature, q, bin_id, lo, hi, good, bad, woe)`` (chosen bins only),
    ``cbins(feature, category, good, bad, woe)`` and ``tot(n, G, B)``."""
    per_q = quantile_fractions(N_BINS)
    union = sorted(set(v for vs in per_q.values() for v in vs))
    qf_vals = ", ".join(f"({q}, {repr(f)})" for q, fr in per_q.items() for f in fr)
    long_num = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, y FROM tr" for c in NUM)
    long_cat = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, COALESCE(CAST({c} AS VARCHAR), '{MISSING_TOKEN}') AS category, y FROM tr" for c in CAT)
    woe = "LN(((good + 1e-6) / (G + 1e-6)) / ((bad + 1e-6) / (B + 1e-6)))"
    return [
        f"tr AS (SELECT * FROM {src})",
        "tot AS (SELECT COUNT(*) AS n, SUM(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS G, SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS B FROM tr)",
        f"long AS ({long_num})",
        f"qa AS (SELECT feature, quantile_cont(x, {_flist(union)}) AS es FROM long GROUP BY feature)",
        f"fr AS (SELECT feature, UNNEST(es) AS e, UNNEST({_flist(union)}) AS frac FROM qa)",
        f"qf AS (SELECT * FROM (VALUES {qf_vals}) v(q, frac))",
        """qe AS (SELECT DISTINCT fr.feature, qf.q, fr.e
               FROM fr JOIN qf ON fr.frac = qf.frac WHERE fr.e IS NOT NULL)""",
        """qb AS (SELECT feature, q, e AS lo, LEAD(e) OVER (PARTITION BY feature, q ORDER BY e) AS hi,
               ROW_NUMBER() OVER (PARTITION BY feature, q ORDER BY e) - 1 AS bin_id,
               COUNT(*) OVER (PARTITION BY feature, q) AS n_edges FROM qe)""",
        """cnt AS (SELECT b.feature, b.q, b.bin_id, b.lo, b.hi, b.n_edges, COUNT(l.x) AS c,
               COALESCE(SUM(CASE WHEN l.y = 0 THEN 1 ELSE 0 END), 0) AS good,
               COALESCE(SUM(CASE WHEN l.y = 1 THEN 1 ELSE 0 END), 0) AS bad
               FROM (SELECT * FROM qb WHERE hi IS NOT NULL) b LEFT JOIN long l ON l.feature = b.feature
                 AND ((l.x > b.lo AND l.x <= b.hi) OR (b.bin_id = 0 AND l.x = b.lo))
               GROUP BY b.feature, b.q, b.bin_id, b.lo, b.hi, b.n_edges)""",
        "st AS (SELECT feature, q, MIN(c) AS minc, MAX(n_edges) AS n_edges FROM cnt GROUP BY feature, q)",
        f"""walk AS (SELECT DISTINCT feature, {N_BINS} AS q, 0 AS step FROM long
               UNION ALL
               SELECT w.feature, s.n_edges - 2, w.step + 1 FROM walk w JOIN st s ON s.feature = w.feature AND s.q = w.q
               JOIN tot ON TRUE WHERE s.minc < tot.n * {MIN_BIN} AND s.n_edges > 3)""",
        "pick AS (SELECT feature, arg_max(q, step) AS q FROM walk GROUP BY feature)",
        f"nbins AS (SELECT cnt.feature, cnt.q, bin_id, lo, hi, good, bad, {woe} AS woe FROM cnt JOIN pick ON cnt.feature = pick.feature AND cnt.q = pick.q JOIN tot ON TRUE)",
        f"""cbins AS (SELECT feature, category, good, bad, {woe} AS woe FROM (
               SELECT feature, category, SUM(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS good,
                      SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS bad FROM ({long_cat}) lc GROUP BY feature, category) g
               JOIN tot ON TRUE)""",
    ]


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def transform_select(alias: str = "t") -> str:
    cols = []
    for c in NUM:
        cols.append(f"""COALESCE((SELECT woe FROM nbins b WHERE b.feature = '{c}' AND
            ((CAST({alias}.{c} AS DOUBLE) > b.lo AND CAST({alias}.{c} AS DOUBLE) <= b.hi) OR (b.bin_id = 0 AND CAST({alias}.{c} AS DOUBLE) = b.lo))), 0.0) AS {c}""")
    for c in CAT:
        cols.append(f"""COALESCE((SELECT woe FROM cbins b WHERE b.feature = '{c}' AND
            b.category = COALESCE(CAST({alias}.{c} AS VARCHAR), '{MISSING_TOKEN}')), 0.0) AS {c}""")
    return ",\n  ".join(cols)


QE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


def _edges_sql() -> str:
    fr = quantile_fractions(N_BINS)[N_BINS]
    long_num = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM tr" for c in QE_FEATURES)
    return with_loans(GAPS_CTE, "tr AS (SELECT * FROM gaps WHERE split = 'train')", f"long AS ({long_num})",
                      f"qa AS (SELECT feature, quantile_cont(x, {_flist(fr)}) AS es FROM long GROUP BY feature)",
                      f"fr AS (SELECT feature, UNNEST(es) AS e, UNNEST({_flist(fr)}) AS frac FROM qa)",
                      "qe AS (SELECT DISTINCT feature, e FROM fr WHERE e IS NOT NULL)",
                      body=f"""SELECT feature, CAST(ROW_NUMBER() OVER (PARTITION BY feature ORDER BY e) - 1 AS INTEGER) AS edge_index,
  {r6('e', 'edge')} FROM qe""")


@register("quantile_edges", _edges_sql())
def q_quantile_edges(spark, sf):
    fr = quantile_fractions(N_BINS)[N_BINS]
    raw = quantile_edges(_train(spark, sf), QE_FEATURES, fr)
    rows = [(c, i, float(e)) for c in QE_FEATURES for i, e in enumerate(dedupe_edges(raw[c]))]
    return out(spark.createDataFrame(rows, "feature string, edge_index int, edge double"))


# A feature of about 2,000 distinct values within 2e-8 of 1: its edges differ in the eleventh digit.
SMALL_SPREAD = "1.0D + CAST(l_orderkey % 2003 AS DOUBLE) * 1e-11D"


def _small_spread_sql() -> str:
    fr = _flist(quantile_fractions(N_BINS)[N_BINS])
    return with_loans("x AS (SELECT CAST(1.0 AS DOUBLE) + CAST(l_orderkey % 2003 AS DOUBLE) * CAST(1e-11 AS DOUBLE) AS x, y FROM loans)",
                      f"e AS (SELECT DISTINCT UNNEST(quantile_cont(x, {fr})) AS lo FROM x)",
                      "b AS (SELECT lo, LEAD(lo) OVER (ORDER BY lo) AS hi, ROW_NUMBER() OVER (ORDER BY lo) - 1 AS bin_id FROM e)",
                      body="""SELECT CAST(bin_id AS INTEGER) AS bin_id, ROUND((lo - 1) * 1e11, 2) AS lower_steps, ROUND((hi - 1) * 1e11, 2) AS upper_steps,
  CAST(SUM(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS good, CAST(SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS bad
FROM b JOIN x ON (x.x > lo AND x.x <= hi) OR (bin_id = 0 AND x.x = lo) WHERE hi IS NOT NULL GROUP BY ALL""")


@register("quantile_edges_small_spread", _small_spread_sql())
def q_quantile_edges_small_spread(spark, sf):
    df = loans_with_gaps(spark, sf).select(F.expr(SMALL_SPREAD).alias("x"), "y")
    bins = numeric_bin_stats(df, ["x"], "y", N_BINS, MIN_BIN)[0][0]
    rows = [(i, lo, hi, g, b) for i, (lo, hi, g, b) in enumerate(zip(bins.edges, bins.edges[1:], bins.good, bins.bad))]
    steps = lambda c: F.round((F.col(c) - 1) * 1e11, 2).alias(f"{c}_steps")
    return spark.createDataFrame(rows, "bin_id int, lower double, upper double, good long, bad long").select(
        "bin_id", steps("lower"), steps("upper"), "good", "bad")


@register("woe_numeric", _recursive(with_loans(GAPS_CTE, *woe_ctes(), body=f"""SELECT feature, CAST(bin_id AS INTEGER) AS bin_id,
  {r6('lo', 'lower')}, {r6('hi', 'upper')}, CAST(good AS BIGINT) AS good, CAST(bad AS BIGINT) AS bad, {r6('woe', 'woe')} FROM nbins""")))
def q_woe_numeric(spark, sf):
    m = fitted(spark, sf)
    return out(m.bins.where(F.col("kind") == "numeric")
               .select("feature", "bin_id", "lower", "upper", "good", "bad", "woe"))


@register("woe_categorical", _recursive(with_loans(GAPS_CTE, *woe_ctes(), body=f"""SELECT feature, category,
  CAST(good AS BIGINT) AS good, CAST(bad AS BIGINT) AS bad, {r6('woe', 'woe')} FROM cbins""")))
def q_woe_categorical(spark, sf):
    m = fitted(spark, sf)
    return out(m.bins.where(F.col("kind") == "categorical").select("feature", "category", "good", "bad", "woe"))


@register("woe_transform", _recursive(with_loans(GAPS_CTE, *woe_ctes(), body=f"""SELECT {", ".join("t." + k for k in LOAN_KEY)}, t.y,
  {transform_select('t')}
FROM gaps t""")).replace(" AS l_quantity,", " AS l_quantity,", 1))
def q_woe_transform(spark, sf):
    m = fitted(spark, sf)
    te = loans_with_gaps(spark, sf).select(*LOAN_KEY, "y", *NUM, *CAT)
    return out(m.transform(te))


def _iv_sql(select_range: bool = False) -> str:
    feats = NUM + CAT
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS v, y FROM enc" for c in feats)
    body = f"""SELECT feature, {r6('SUM((gp - bp) * LN(gp / bp))', 'iv')}, CAST(COUNT(*) AS BIGINT) AS n_bins
FROM (SELECT feature, (good + 1e-10) / (G + 1e-10) AS gp, (bad + 1e-10) / (B + 1e-10) AS bp FROM (
  SELECT feature, v, SUM(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS good, SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS bad
  FROM ({long}) l WHERE v IS NOT NULL GROUP BY feature, v) g JOIN tot ON TRUE) x GROUP BY feature"""
    ivq = f"iv AS ({body})"
    sel = ("SELECT feature, iv FROM iv WHERE iv >= 0.02 AND iv <= 0.5" if select_range else
           """SELECT feature, iv, n_bins, CASE WHEN iv < 0.02 THEN 'not_useful' WHEN iv < 0.1 THEN 'weak'
  WHEN iv < 0.3 THEN 'medium' WHEN iv < 0.5 THEN 'strong' ELSE 'suspicious' END AS strength FROM iv""")
    return _recursive(with_loans(GAPS_CTE, *woe_ctes(), f"enc AS (SELECT t.y, {transform_select('t')} FROM tr t)", ivq,
                                 body=sel))


def _iv(spark, sf):
    m = fitted(spark, sf)
    enc = m.transform(_train(spark, sf).select(*NUM, *CAT, "y"))
    return calculate_iv(enc, "y", NUM + CAT)


@register("iv_table", _iv_sql())
def q_iv_table(spark, sf):
    return out(_iv(spark, sf))


@register("iv_select", _iv_sql(select_range=True))
def q_iv_select(spark, sf):
    return out(select_by_iv(_iv(spark, sf), 0.02, 0.5).select("feature", "iv"))
