"""Registered query: streaming PSI over the events table (T2), run to completion with availableNow."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskframe.operators.drift_state import DriftState
from riskframe.plans.common import out
from riskframe.plans.q_drift import period_psi_sql
from riskframe.plans.registry import register
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.tables import events_frame
from riskframe.streaming.psi_stream import fit_baseline, start_drift_state_stream, start_psi_monitor

BASELINE_END = "2024-01-08"


@register("psi_stream", period_psi_sql("1 day", closed_after="1 day"))
def q_psi_stream(spark, sf):
    ev = events_frame(spark, sf)
    baseline = fit_baseline(ev.where(F.col("ts") < F.lit(BASELINE_END).cast("timestamp_ntz")), "value")
    # The file source watches a folder; the glob keeps it to the events file(s).
    stream = (spark.readStream.schema(ev.schema).option("pathGlobFilter", "events*.parquet")
              .option("maxFilesPerTrigger", 1).parquet(sf))
    q, path = start_psi_monitor(spark, stream, baseline, "value", "ts", window="1 day", watermark="1 day")
    q.awaitTermination()
    return out(spark.read.parquet(path).drop("batch_id")
               .select("window_start", "psi", "interpretation", "n_expected", "n_actual"))


# The events reach the stream in four deliveries, one per group of users, so most rows of the later ones are late.
DELIVERIES = 4


def _all_windows_sql() -> str:
    psi = period_psi_sql("1 day")
    group = f"COALESCE(user_id, 0) % {DELIVERIES}"
    return f"""WITH psi AS ({psi}),
ar AS (SELECT {group} AS d, MAX(ts) AS last FROM events WHERE value IS NOT NULL GROUP BY 1),
ev AS (SELECT ts, (SELECT MAX(last) FROM ar WHERE ar.d < {group}) AS seen FROM events WHERE value IS NOT NULL),
lt AS (SELECT CAST(time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') AS VARCHAR) AS window_start,
  CAST(SUM(CASE WHEN ts < seen - INTERVAL '1 day' THEN 1 ELSE 0 END) AS BIGINT) AS late_rows FROM ev GROUP BY 1)
SELECT psi.*, late_rows FROM psi JOIN lt USING (window_start)"""


@register("psi_stream_all", _all_windows_sql())
def q_psi_stream_all(spark, sf):
    """Every window of the events, open ones too, with its late rows, from a stream that is read delivery by delivery."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/psi_stream_all/{uuid.uuid4().hex[:12]}"
    ev = events_frame(spark, sf)
    before = F.col("ts") < F.lit(BASELINE_END).cast("timestamp_ntz")
    state = DriftState.create(ev.where(before), f"{root}/state", ["value"], "ts")
    group = F.pmod(F.coalesce("user_id", F.lit(0)), F.lit(DELIVERIES))
    for d in range(DELIVERIES):
        ev.where(group == d).select("ts", "value").coalesce(1).write.parquet(f"{root}/in/delivery={d}")
        stream = spark.readStream.schema("ts timestamp_ntz, value double").parquet(f"{root}/in/delivery=*")
        start_drift_state_stream(spark, stream, state, "1 day", f"{root}/checkpoint").awaitTermination()
    return out(state.by_period(spark, "value", (None, BASELINE_END)))
