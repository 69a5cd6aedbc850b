"""Discrimination/calibration bundles and the threshold table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.bins import left_closed_index, linspace
from riskframe.functions.exprs import safe_div
from riskframe.operators.calibration import calibration_from_bins, reliability_bins
from riskframe.operators.curves import collapse_scores, ranking_metrics
from riskframe.session import persist

# Default decision threshold and threshold grid.
DEFAULT_THRESHOLD = 0.5
DEFAULT_GRID = (0.01, 0.50, 50)


def point_metrics(collapsed: DataFrame, score: str, by: Sequence[str] = (), threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """R5 Brier = mean (p - y)^2 and R6 F1 at ``threshold`` (positive iff p >= t; 0 if undefined)."""
    s = F.col(score)
    pos, neg = F.col("pos"), F.col("neg")
    hit = (s >= F.lit(threshold)) & ~F.isnan(s)  # NaN is never >= t (numpy), though Spark orders it last
    tp = F.sum(F.when(hit, pos).otherwise(0.0))
    fp = F.sum(F.when(hit, neg).otherwise(0.0))
    fn = F.sum(F.when(~hit, pos).otherwise(0.0))
    return collapsed.groupBy(*by).agg(
        (F.sum(pos * (s - 1.0) * (s - 1.0) + neg * s * s) / F.sum(pos + neg)).alias("brier"),
        safe_div(2.0 * tp, 2.0 * tp + fp + fn).alias("f1"),
        F.sum(pos + neg).cast("long").alias("n"),
        F.sum(pos).cast("long").alias("n_pos"),
    )


def _join_on(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    if by:
        return left.join(right, on=list(by), how="left")
    return left.withColumn("_k", F.lit(1)).join(right.withColumn("_k", F.lit(1)), on="_k").drop("_k")


def evaluate_all(df: DataFrame, target: str, score: str, by: Sequence[str] = (), threshold: float = DEFAULT_THRESHOLD,
                 n_bins: int = 10, n_buckets: int | None = None) -> DataFrame:
    """One row per group with auc, pr_auc, gini, ks, brier, f1, ece, mce, calibration slope/intercept.

    One scan collapses rows to distinct scores; every metric then reads that
    (much smaller) frame: one shuffle by score, one by bin."""
    collapsed = persist(collapse_scores(df, target, score, by))
    rank = ranking_metrics(df, target, score, by, n_buckets=n_buckets, collapsed=collapsed)
    point = point_metrics(collapsed, score, by, threshold)
    calib = calibration_from_bins(reliability_bins(collapsed, score, by, n_bins), by)
    return _join_on(_join_on(point, rank, by), calib, by)


def compare_models(df: DataFrame, target: str, score_cols: Sequence[str], threshold: float = DEFAULT_THRESHOLD,
                   n_bins: int = 10) -> DataFrame:
    """Unpivot the model score columns to ``(model, score)`` and evaluate all models in one job."""
    long = df.select(target, *score_cols).unpivot([target], list(score_cols), "model", "score")
    return evaluate_all(long, target, "score", by=["model"], threshold=threshold, n_bins=n_bins)


def threshold_table(df: DataFrame, target: str, score: str, thresholds: Sequence[float] | None = None) -> DataFrame:
    """One row per threshold; decline iff score >= threshold.

    One pass buckets every row by the number of thresholds <= score (a CASE over
    the literals), then suffix sums over <= len(thresholds)+1 bucket rows give the
    confusion counts of every threshold. Never rows x thresholds.

    Column names follow the reference (``bad_rate`` = precision among declined,
    ``false_decline_rate`` = default rate among approved); the correctly named
    ``bad_rate_approved`` and ``false_decline_rate_of_goods`` are added.
    """
    ts = sorted(float(t) for t in (thresholds if thresholds is not None else linspace(*DEFAULT_GRID)))
    spark = df.sparkSession
    y = F.col(target)
    buckets = (
        df.where(F.col(score).isNotNull())
        # a NaN score is never >= a threshold (numpy semantics): bucket 0, always approved
        .select(F.when(F.isnan(F.col(score)), F.lit(0)).otherwise(left_closed_index(F.col(score), ts)).alias("b"),
                y.alias("_y"))
        .groupBy("b")
        .agg(F.sum(F.when(F.col("_y") == 1, 1).otherwise(0)).cast("long").alias("bp"),
             F.sum(F.when(F.col("_y") == 0, 1).otherwise(0)).cast("long").alias("bn"))
    )
    grid = spark.createDataFrame([(i + 1, t) for i, t in enumerate(ts)], "b int, threshold double")
    # Bounded frame: one row per threshold bucket (<= len(ts) + 1 rows).
    full = grid.join(buckets, on="b", how="full_outer").na.fill(0, ["bp", "bn"])
    w_suffix = Window.orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, 0)
    w_all = Window.partitionBy(F.lit(1))
    counted = full.select(
        "b", "threshold",
        F.sum("bp").over(w_suffix).alias("tp"), F.sum("bn").over(w_suffix).alias("fp"),
        F.sum("bp").over(w_all).alias("P"), F.sum("bn").over(w_all).alias("N"),
    ).where(F.col("threshold").isNotNull())
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("P") - tp, F.col("N") - fp
    return counted.select(
        "threshold",
        safe_div(fn + tn, F.col("P") + F.col("N")).alias("approval_rate"),
        safe_div(tp, tp + fp).alias("bad_rate"),
        safe_div(tp, tp + fn).alias("default_capture_rate"),
        safe_div(fn, fn + tn).alias("false_decline_rate"),
        safe_div(tp, tp + fp).alias("precision"),
        safe_div(tp, tp + fn).alias("recall"),
        safe_div(fn, fn + tn).alias("bad_rate_approved"),
        safe_div(fp, fp + tn).alias("false_decline_rate_of_goods"),
        tp.cast("long").alias("tp"), fp.cast("long").alias("fp"),
        fn.cast("long").alias("fn"), tn.cast("long").alias("tn"),
    )
