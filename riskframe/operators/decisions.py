"""Risk bands, decision metrics, threshold choice and segment analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.exprs import risk_band, safe_div
from riskframe.operators.curves import ranking_metrics
from riskframe.operators.metrics import threshold_table

# Default PD band cut-offs.
LOW_PD = 0.10
HIGH_PD = 0.30
OBJECTIVES = ("min_bad_rate", "max_approval", "balanced")


def assign_risk_band(df: DataFrame, score: str, low: float = LOW_PD, high: float = HIGH_PD,
                     out: str = "risk_band") -> DataFrame:
    """Low (< low) / Medium / High (>= high, wins ties; missing score -> Medium)."""
    return df.withColumn(out, risk_band(score, low, high))


def decision_metrics(df: DataFrame, target: str, score: str, low: float = LOW_PD, high: float = HIGH_PD,
                     by: Sequence[str] = ()) -> DataFrame:
    """approve = Low, review = Medium, decline = High; one conditional-sum aggregate.

    approval/review/decline rates and counts, bad rate among approved, default
    capture (defaults declined / defaults), false decline (goods declined / goods)."""
    band = risk_band(score, low, high)
    y = F.col(target)
    ind = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    agg = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_total"),
        ind(band == "Low").alias("n_approve"),
        ind(band == "Medium").alias("n_review"),
        ind(band == "High").alias("n_decline"),
        ind((band == "Low") & (y == 1)).alias("_bad_appr"),
        ind((band == "High") & (y == 1)).alias("_bad_decl"),
        ind((band == "High") & (y == 0)).alias("_good_decl"),
        ind(y == 1).alias("_bad"),
        ind(y == 0).alias("_good"),
    )
    n = F.col("n_total")
    return agg.select(
        *by,
        safe_div(F.col("n_approve"), n).alias("approval_rate"),
        safe_div(F.col("n_review"), n).alias("review_rate"),
        safe_div(F.col("n_decline"), n).alias("decline_rate"),
        safe_div(F.col("_bad_appr"), F.col("n_approve")).alias("bad_rate_approved"),
        safe_div(F.col("_bad_decl"), F.col("_bad")).alias("default_capture_rate"),
        safe_div(F.col("_good_decl"), F.col("_good")).alias("false_decline_rate"),
        "n_approve", "n_review", "n_decline", "n_total",
    )


def find_optimal_threshold(df: DataFrame, target: str, score: str, objective: str = "min_bad_rate",
                           min_approval: float = 0.0, max_bad_rate: float = 1.0,
                           thresholds: Sequence[float] | None = None) -> DataFrame:
    """Best row of the threshold table under constraints; first (lowest) threshold on ties.

    Returns one row; when nothing satisfies the constraints the row has a null
    threshold and a ``reason``."""
    if objective not in OBJECTIVES:
        raise ValueError(f"Unknown objective: {objective}")
    tt = threshold_table(df, target, score, thresholds)
    ok = tt.where((F.col("approval_rate") >= min_approval) & (F.col("bad_rate") <= max_bad_rate))
    ok = ok.withColumn("objective_value", {
        "min_bad_rate": -F.col("bad_rate"),
        "max_approval": F.col("approval_rate"),
        "balanced": F.col("approval_rate") - F.col("bad_rate"),
    }[objective])
    best = ok.orderBy(F.col("objective_value").desc(), F.col("threshold").asc()).limit(1)
    placeholder = df.sparkSession.range(1).select(F.lit(1).alias("_k"))
    picked = placeholder.join(best.withColumn("_k", F.lit(1)), on="_k", how="left").drop("_k")
    return picked.select(
        "threshold", "approval_rate", "bad_rate", "default_capture_rate", "false_decline_rate",
        F.lit(objective).alias("objective"),
        F.when(F.col("threshold").isNull(), F.lit("No threshold satisfies constraints")).alias("reason"),
    )


def segment_analysis(df: DataFrame, target: str, score: str, segment: str, low: float = LOW_PD,
                     high: float = HIGH_PD, min_size: int = 10) -> DataFrame:
    """Decision metrics, size and AUC per segment; segments with < ``min_size`` rows
    or a null key are skipped; AUC is 0.5 when a segment has one class."""
    d = decision_metrics(df.where(F.col(segment).isNotNull()), target, score, low, high, by=[segment])
    d = d.where(F.col("n_total") >= min_size).withColumnRenamed("n_total", "sample_size")
    auc = ranking_metrics(df.where(F.col(segment).isNotNull()), target, score, by=[segment]).select(segment, "auc")
    return (d.join(auc, on=segment, how="left")
            .withColumn("auc", F.coalesce(F.col("auc"), F.lit(0.5)))
            .withColumnRenamed(segment, "segment"))


# Decision of each risk band.
BAND_DECISIONS = {"Low": "Approve", "Medium": "Manual Review", "High": "Decline"}


def assign_decision(df: DataFrame, score: str, low: float = LOW_PD, high: float = HIGH_PD,
                    out: str = "decision") -> DataFrame:
    """Band -> Approve / Manual Review / Decline (the scoring decision)."""
    band = risk_band(score, low, high)
    expr = None
    for b, d in BAND_DECISIONS.items():
        expr = F.when(band == b, d) if expr is None else expr.when(band == b, d)
    return df.withColumn(out, expr)
