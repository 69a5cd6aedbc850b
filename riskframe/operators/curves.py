"""Cumulative score curves without a single-partition window (R1-R4 core).

A ranking metric needs, for every distinct score, the positives/negatives with a
smaller score. ``Window.orderBy`` without a partition would pull the whole table
into one task, so the prefix sum is two-level:

1. collapse rows to distinct ``(by, score)`` with map-side partial aggregation
   (a hot score value becomes one row, so a skewed score cannot overload a task);
2. cut the distinct scores into ~``n_buckets`` ranges at approximate quantiles
   (only the ``n_buckets`` cut points reach the driver) and bucket each score by
   binary search;
3. per-bucket totals (groups x buckets rows) give exclusive offsets;
4. a window partitioned by ``(by, bucket)`` adds the within-bucket running sum.

The result is exact; only the balance of the buckets is approximate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.bins import bucketize_frame
from riskframe.session import persist


def collapse_scores(df: DataFrame, target: str, score: str, by: Sequence[str] = (),
                    weight: str | None = None) -> DataFrame:
    """Distinct scores with positive/negative counts: ``(by..., score, pos, neg)`` (doubles)."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    y = F.col(target)
    return (
        df.where(F.col(score).isNotNull() & y.isNotNull())
        .groupBy(*by, score)
        .agg(F.sum(F.when(y == 1, w).otherwise(F.lit(0.0))).alias("pos"),
             F.sum(F.when(y == 0, w).otherwise(F.lit(0.0))).alias("neg"))
    )


def _n_buckets(df: DataFrame, n_buckets: int | None) -> int:
    if n_buckets:
        return n_buckets
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def prefix_below(collapsed: DataFrame, score: str, by: Sequence[str] = (),
                 cols: Sequence[str] = ("pos", "neg"), n_buckets: int | None = None,
                 persist_input: bool = True) -> DataFrame:
    """Add ``<c>_below`` (sum of c over strictly smaller scores in the group) and
    ``<c>_total`` (group total) for each c in ``cols``."""
    by = list(by)
    k = _n_buckets(collapsed, n_buckets)
    base = persist(collapsed) if persist_input else collapsed
    if k > 1:
        probs = [i / k for i in range(1, k)]
        row = base.agg(F.percentile_approx(score, probs, 10000).alias("q")).first()
        cuts = sorted(set(v for v in (row["q"] or []) if v is not None))
    else:
        cuts = []
    bucketed = bucketize_frame(base, score, cuts, "_b")

    # Bucket totals: at most groups x k rows; ordered windows over them are bounded by k.
    tot = bucketed.groupBy(*by, "_b").agg(*[F.sum(c).alias(f"_bt_{c}") for c in cols])
    w_ord = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*by)
    offsets = tot.select(
        *by, "_b",
        *[F.coalesce(F.sum(f"_bt_{c}").over(w_ord), F.lit(0.0)).alias(f"_off_{c}") for c in cols],
        *[F.sum(f"_bt_{c}").over(w_all).alias(f"{c}_total") for c in cols],
    )
    w_in = Window.partitionBy(*by, "_b").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    joined = bucketed.join(offsets, on=[*by, "_b"], how="inner")
    return joined.select(
        *by, score, *cols,
        *[(F.coalesce(F.sum(c).over(w_in), F.lit(0.0)) + F.col(f"_off_{c}")).alias(f"{c}_below") for c in cols],
        *[F.col(f"{c}_total") for c in cols],
    )


def ranking_metrics(df: DataFrame, target: str, score: str, by: Sequence[str] = (),
                    n_buckets: int | None = None, collapsed: DataFrame | None = None) -> DataFrame:
    """``auc``, ``gini``, ``ks``, ``pr_auc`` (step-wise average precision) per group.

    AUC = sum pos*(neg_below + neg/2) / (P*N) (tie aware, = Mann-Whitney);
    KS = max(0, max over thresholds of tpr - fpr); AP = sum precision(>= s) * pos/P.
    Null when a class is absent.
    """
    c = collapsed if collapsed is not None else collapse_scores(df, target, score, by)
    pre = prefix_below(c, score, by, n_buckets=n_buckets)
    P, N = F.col("pos_total"), F.col("neg_total")
    cp, cn = P - F.col("pos_below"), N - F.col("neg_below")
    auc = F.try_divide(F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)), F.max(P) * F.max(N))
    ks = F.greatest(F.lit(0.0), F.max(F.try_divide(F.col("neg_below"), N) - F.try_divide(F.col("pos_below"), P)))
    ap = F.try_divide(F.sum(F.try_divide(cp, cp + cn) * F.col("pos")), F.max(P))
    out = pre.groupBy(*by).agg(auc.alias("auc"), ks.alias("ks"), ap.alias("pr_auc"))
    return out.withColumn("gini", F.lit(2.0) * F.col("auc") - F.lit(1.0))
