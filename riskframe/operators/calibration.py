"""Reliability curve and calibration error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.bins import left_closed_index, linspace
from riskframe.functions.exprs import logit_eps
from riskframe.operators.curves import collapse_scores


def reliability_bins(collapsed: DataFrame, score: str, by: Sequence[str] = (), n_bins: int = 10) -> DataFrame:
    """R7 from a collapsed ``(by, score, pos, neg)`` frame.

    Equal-width, left-closed bins on linspace(0, 1, n+1), clipped to [0, n-1]
    (so 1.0 and any outlier land in the end bins). Empty bins are absent.
    Columns: bin, mean_pred, event_rate, n.
    """
    interior = linspace(0.0, 1.0, n_bins + 1)[1:-1]
    cnt = F.col("pos") + F.col("neg")
    return (
        collapsed.withColumn("bin", left_closed_index(F.col(score), interior))
        .groupBy(*by, "bin")
        .agg(F.sum(F.col(score) * cnt).alias("_sp"), F.sum("pos").alias("_pos"), F.sum(cnt).alias("_n"))
        .where(F.col("_n") > 0)
        .select(*by, "bin",
                (F.col("_sp") / F.col("_n")).alias("mean_pred"),
                (F.col("_pos") / F.col("_n")).alias("event_rate"),
                F.col("_n").cast("long").alias("n"))
    )


def reliability_curve(df: DataFrame, target: str, score: str, by: Sequence[str] = (), n_bins: int = 10) -> DataFrame:
    return reliability_bins(collapse_scores(df, target, score, by), score, by, n_bins)


def calibration_from_bins(bins: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ECE (count-weighted mean |mean_pred - rate|), MCE (max), and the
    unweighted OLS slope/intercept of logit(rate) on logit(mean_pred) over bins;
    a single bin gives slope 1, intercept 0."""
    gap = F.abs(F.col("mean_pred") - F.col("event_rate"))
    lx, ly = logit_eps(F.col("mean_pred")), logit_eps(F.col("event_rate"))
    nb = F.count(F.lit(1))
    return bins.groupBy(*by).agg(
        (F.sum(gap * F.col("n")) / F.sum("n")).alias("ece"),
        F.max(gap).alias("mce"),
        F.when(nb > 1, F.regr_slope(ly, lx)).otherwise(F.lit(1.0)).alias("calibration_slope"),
        F.when(nb > 1, F.regr_intercept(ly, lx)).otherwise(F.lit(0.0)).alias("calibration_intercept"),
        nb.cast("long").alias("n_bins_used"),
    )


def calibration_metrics(df: DataFrame, target: str, score: str, by: Sequence[str] = (), n_bins: int = 10) -> DataFrame:
    return calibration_from_bins(reliability_curve(df, target, score, by, n_bins), by)
