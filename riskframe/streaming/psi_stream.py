"""Streaming population stability.

The baseline (edges and expected share per bucket, <= buckets+1 numbers) is fitted
once on a static reference frame. The stream is bucketed with the same left-closed
CASE, counted per event-time tumbling window with a watermark (state is one counter
per open window and bucket), emitted in append mode when a window closes, and
turned into one PSI row per window inside ``foreachBatch``. Each micro-batch is
written to its own ``batch_id=<n>`` folder with overwrite, so a replay after a
failure rewrites the same output (idempotent sink).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskframe.functions.bins import left_closed_index
from riskframe.functions.exprs import PSI_FLOOR, psi_label
from riskframe.operators.binning import clean_double
from riskframe.operators.drift import _edges_for
from riskframe.operators.drift_state import DriftState
from riskframe.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class PsiBaseline:
    edges: list[float]
    expected_pct: list[float]   # floored shares per bucket
    n_expected: int

    def bucket(self, x: F.Column) -> F.Column:
        return left_closed_index(x, self.edges[1:-1])


def fit_baseline(reference: DataFrame, col: str, buckets: int = 10) -> PsiBaseline:
    """Edges from the reference quantiles and its share per bucket (two small jobs)."""
    edges = _edges_for(reference, {"e": clean_double(col)}, buckets)["e"]
    if len(edges) < 2:
        raise ValueError("baseline needs at least two distinct edges")
    x = clean_double(col)
    b = left_closed_index(x, edges[1:-1])
    rows = reference.where(x.isNotNull()).groupBy(b.alias("bucket")).count().collect()  # <= buckets rows
    counts = {r["bucket"]: r["count"] for r in rows}
    n = sum(counts.values())
    pct = [max(counts.get(i, 0) / n, PSI_FLOOR) for i in range(len(edges) - 1)]
    return PsiBaseline(edges, pct, n)


def psi_window_counts(stream: DataFrame, baseline: PsiBaseline, col: str, ts_col: str, window: str = "1 day",
                      watermark: str = "1 day") -> DataFrame:
    """Streaming aggregate: (window_start, bucket, n) per event-time window.

    ``withWatermark`` needs a ``timestamp`` column, so a ``timestamp_ntz`` event time
    is cast (session time zone UTC keeps wall-clock values)."""
    ts = F.col(ts_col).cast("timestamp")
    x = clean_double(col)
    return (stream.where(x.isNotNull())
            .select(ts.alias("__ts"), baseline.bucket(x).alias("bucket"))
            .withWatermark("__ts", watermark)
            .groupBy(F.window("__ts", window).alias("w"), "bucket")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), "bucket", "n"))


def psi_from_counts(counts: DataFrame, baseline: PsiBaseline) -> DataFrame:
    """PSI per window from (window_start, bucket, n); missing buckets count zero."""
    k = len(baseline.edges) - 1
    exp = counts.sparkSession.createDataFrame([(i, float(p)) for i, p in enumerate(baseline.expected_pct)],
                                              "bucket int, ep double")
    ids = F.array(*[F.lit(i) for i in range(k)])
    grid = counts.select("window_start").distinct().select("window_start", F.explode(ids).alias("bucket"))
    full = (grid.join(counts, on=["window_start", "bucket"], how="left").na.fill(0, ["n"])
            .join(exp, on="bucket", how="inner"))
    tot = full.groupBy("window_start").agg(F.sum("n").alias("na"))
    j = full.join(tot, on="window_start")
    ap = F.greatest(F.col("n") / F.col("na"), F.lit(PSI_FLOOR))
    return (j.groupBy("window_start")
            .agg(F.sum((ap - F.col("ep")) * F.log(ap / F.col("ep"))).alias("psi"), F.max("na").cast("long").alias("n_actual"))
            .withColumn("interpretation", psi_label("psi"))
            .withColumn("n_expected", F.lit(baseline.n_expected).cast("long")))


def start_psi_monitor(spark: SparkSession, stream: DataFrame, baseline: PsiBaseline, col: str, ts_col: str,
                      output_path: str | None = None, checkpoint_path: str | None = None, window: str = "1 day",
                      watermark: str = "1 day", trigger: dict | None = None) -> tuple[StreamingQuery, str]:
    """Start the monitor; returns (query, output_path). Paths default to fresh folders under
    the session's shared ``spark.checkpoint.dir``."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    run = uuid.uuid4().hex[:12]
    output_path = output_path or f"{root}/psi_monitor/{run}/out"
    checkpoint_path = checkpoint_path or f"{root}/psi_monitor/{run}/checkpoint"
    counts = psi_window_counts(stream, baseline, col, ts_col, window, watermark)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        res = psi_from_counts(batch, baseline).withColumn("window_start", F.col("window_start").cast("string"))
        res.write.mode("overwrite").parquet(f"{output_path}/batch_id={batch_id}")

    writer = (counts.writeStream.outputMode("append").foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start(), output_path


def start_drift_state_stream(spark: SparkSession, stream: DataFrame, state: DriftState, late_after: str = "1 day",
                             checkpoint_path: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Count a stream into a drift state, one batch folder per micro-batch.

    Every period is readable after every micro-batch (open ones too), rows beyond ``late_after`` are counted in their
    period and as late instead of dropped, and the query keeps no state of its own: a micro-batch replayed after a failure
    replaces its folder with the same counts. Give ``checkpoint_path`` to go on after a restart."""
    checkpoint_path = checkpoint_path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/drift_state/{uuid.uuid4().hex[:12]}"
    writer = (stream.writeStream.foreachBatch(lambda batch, batch_id: state.append(batch, batch_id, late_after))
              .option("checkpointLocation", checkpoint_path))
    return writer.trigger(**(trigger or {"availableNow": True})).start()
