"""Registered queries: population stability."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskframe.operators.drift import calculate_psi, drift_report, psi_buckets, psi_by_period, psi_report, variable_psi
from riskframe.operators.drift_state import DriftState
from riskframe.plans.common import out
from riskframe.plans.registry import register
from riskframe.plans.sql import psi_ctes, psi_label_sql, r6, with_loans
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.tables import SPLIT_TEST_END, SPLIT_TRAIN_END, events_frame, loans, split_filter

PSI_VARS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
BASELINE_END = "2024-01-08"
PERIOD = "7 days"


def _parts(spark, sf):
    l = loans(spark, sf)
    return l, l.where(split_filter("train")), l.where(split_filter("test")), l.where(split_filter("oot"))


@register("psi_score", with_loans(
    psi_ctes("SELECT 'k' AS key, p AS x FROM loans WHERE split = 'train'", "SELECT 'k' AS key, p AS x FROM loans WHERE split = 'test'"),
    body=f"SELECT {r6('SUM(contrib)', 'psi')}, {psi_label_sql('SUM(contrib)')} AS interpretation FROM psi_det"))
def q_psi_score(spark, sf):
    _, tr, te, _ = _parts(spark, sf)
    return out(calculate_psi(tr, te, "p"))


DETAIL_SQL = (f"CAST(bucket AS INTEGER) AS bucket, {r6('lo', 'bin_edge_lower')}, {r6('hi', 'bin_edge_upper')}, "
              "CAST(ec AS BIGINT) AS expected_count, CAST(ac AS BIGINT) AS actual_count, "
              f"{r6('ep', 'expected_pct')}, {r6('ap', 'actual_pct')}, {r6('contrib', 'psi_contribution')}, "
              "CAST(ne AS BIGINT) AS n_expected, CAST(na AS BIGINT) AS n_actual")


@register("psi_buckets", with_loans(
    psi_ctes("SELECT 'k' AS key, p AS x FROM loans WHERE split = 'train'", "SELECT 'k' AS key, p AS x FROM loans WHERE split = 'oot'"),
    body=f"SELECT {DETAIL_SQL} FROM psi_det"))
def q_psi_buckets(spark, sf):
    _, tr, _, oot = _parts(spark, sf)
    return out(psi_buckets(tr, oot, "p"))


def _vars_src(part: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS key, CAST({c} AS DOUBLE) AS x FROM loans WHERE split = '{part}'" for c in PSI_VARS)


@register("psi_variables", with_loans(psi_ctes(_vars_src("train"), _vars_src("oot")),
                                      body=f"""SELECT key AS variable, {r6('SUM(contrib)', 'psi')}, {psi_label_sql('SUM(contrib)')} AS interpretation
FROM psi_det GROUP BY key"""))
def q_psi_variables(spark, sf):
    _, tr, _, oot = _parts(spark, sf)
    return out(variable_psi(tr, oot, PSI_VARS))


_REPORT_E = """SELECT 'score_psi_test_vs_train' AS key, p AS x FROM loans WHERE split = 'train'
  UNION ALL SELECT 'score_psi_oot_vs_train', p FROM loans WHERE split = 'train'
  UNION ALL SELECT 'score_psi_oot_vs_test', p FROM loans WHERE split = 'test'"""
_REPORT_A = """SELECT 'score_psi_test_vs_train' AS key, p AS x FROM loans WHERE split = 'test'
  UNION ALL SELECT 'score_psi_oot_vs_train', p FROM loans WHERE split = 'oot'
  UNION ALL SELECT 'score_psi_oot_vs_test', p FROM loans WHERE split = 'oot'"""


@register("psi_report", with_loans(psi_ctes(_REPORT_E, _REPORT_A), body=f"SELECT key AS comparison, {DETAIL_SQL} FROM psi_det"))
def q_psi_report(spark, sf):
    l, _, _, _ = _parts(spark, sf)
    return out(psi_report(l, "p", "split"))


def period_psi_sql(interval: str, closed_after: str | None = None) -> str:
    """PSI of every event-time window against the baseline. ``closed_after`` keeps only windows an
    append-mode stream has closed: window end <= max(ts) - watermark delay."""
    closed = (f"WHERE CAST(window_start AS TIMESTAMP) + INTERVAL '{interval}' <= "
              f"(SELECT MAX(ts) FROM events) - INTERVAL '{closed_after}'") if closed_after else ""
    return with_loans(
        psi_ctes(f"SELECT 'k' AS key, value AS x FROM events WHERE ts < TIMESTAMP '{BASELINE_END}'", "SELECT 'k' AS key, value AS x FROM events"),
        "eb AS (SELECT bucket, ec, ne FROM psi_det)",
        f"""wa AS (SELECT CAST(time_bucket(INTERVAL '{interval}', ts, TIMESTAMP '1970-01-01') AS VARCHAR) AS window_start,
                 (SELECT COUNT(*) FROM pedo WHERE pedo.i >= 1 AND pedo.i <= pedo.k - 2 AND pedo.v <= value) AS bucket
          FROM events WHERE value IS NOT NULL)""",
        "wc AS (SELECT window_start, bucket, COUNT(*) AS ac FROM wa GROUP BY 1, 2)",
        "wg AS (SELECT w.window_start, eb.bucket, eb.ec, eb.ne FROM (SELECT DISTINCT window_start FROM wa) w JOIN eb ON TRUE)",
        """wd AS (SELECT wg.window_start, wg.bucket, wg.ec, wg.ne, CAST(COALESCE(wc.ac, 0) AS DOUBLE) AS ac FROM wg
          LEFT JOIN wc ON wg.window_start = wc.window_start AND wg.bucket = wc.bucket)""",
        """wp AS (SELECT window_start, ne, SUM(ac) OVER (PARTITION BY window_start) AS na, GREATEST(ec / ne, 1e-10) AS ep,
                 GREATEST(ac / SUM(ac) OVER (PARTITION BY window_start), 1e-10) AS ap FROM wd)""",
        body=f"""SELECT window_start, {r6('SUM((ap - ep) * LN(ap / ep))', 'psi')}, {psi_label_sql('SUM((ap - ep) * LN(ap / ep))')} AS interpretation,
  CAST(MAX(ne) AS BIGINT) AS n_expected, CAST(MAX(na) AS BIGINT) AS n_actual FROM wp {closed} GROUP BY window_start""")


_PERIOD_SQL = period_psi_sql(PERIOD)


@register("psi_by_period", _PERIOD_SQL)
def q_psi_by_period(spark, sf):
    return out(psi_by_period(events_frame(spark, sf), "value", "ts", BASELINE_END, PERIOD))


def _labelled(src: str) -> str:
    return src.replace("SELECT '", "SELECT 'score|")


@register("drift_report", with_loans(
    psi_ctes(f"{_labelled(_REPORT_E)} UNION ALL {_vars_src('train').replace(chr(39) + 'l_', chr(39) + 'variable|l_')}",
             f"{_labelled(_REPORT_A)} UNION ALL {_vars_src('oot').replace(chr(39) + 'l_', chr(39) + 'variable|l_')}"),
    body=f"""SELECT split_part(key, '|', 1) AS section, split_part(key, '|', 2) AS name, {r6('SUM(contrib)', 'psi')},
  {psi_label_sql('SUM(contrib)')} AS interpretation FROM psi_det GROUP BY key"""))
def q_drift_report(spark, sf):
    """W6 with its variable section from the rows."""
    l, _, _, _ = _parts(spark, sf)
    return out(drift_report(l, "p", "split", PSI_VARS))


STATE_VARS = ["p", *PSI_VARS]
STATE_COMPARISONS = {"test_vs_train": ((None, SPLIT_TRAIN_END), (SPLIT_TRAIN_END, SPLIT_TEST_END)),
                     "oot_vs_train": ((None, SPLIT_TRAIN_END), (SPLIT_TEST_END, None))}


def _state_src(expected: bool) -> str:
    part = lambda name: "train" if expected else name.split("_")[0]
    return " UNION ALL ".join(
        f"SELECT '{n}|{v}' AS key, CAST({v} AS DOUBLE) AS x FROM loans WHERE split = '{part(n)}' AND l_shipdate IS NOT NULL"
        for n in STATE_COMPARISONS for v in STATE_VARS)


@register("drift_state_report", with_loans(
    psi_ctes(_state_src(True), _state_src(False)),
    body=f"""SELECT CASE WHEN split_part(key, '|', 2) = 'p' THEN 'score' ELSE 'variable' END AS section, split_part(key, '|', 1) AS comparison,
  split_part(key, '|', 2) AS variable, {r6('SUM(contrib)', 'psi')}, {psi_label_sql('SUM(contrib)')} AS interpretation,
  CAST(MAX(ne) AS BIGINT) AS n_expected, CAST(MAX(na) AS BIGINT) AS n_actual FROM psi_det GROUP BY key"""))
def q_drift_state_report(spark, sf):
    """W6 with its variable section, from counts that were appended part by part (out of time first)."""
    l, tr, te, oot = _parts(spark, sf)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/drift_state_report/{uuid.uuid4().hex[:12]}"
    state = DriftState.create(tr.where(F.col("l_shipdate").isNotNull()), path, STATE_VARS, "l_shipdate")
    for batch, part in enumerate((oot, tr, te)):
        state.append(part, batch)
    return out(state.summary(spark, STATE_COMPARISONS, score="p"))
